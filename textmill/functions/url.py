"""Source label from a URL: host (or path when there is no host), "www."
removed everywhere, split on dots: more than two labels -> second to last,
two -> the whole domain, otherwise "web"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def source_from_url(url: Column) -> Column:
    rest = F.regexp_replace(url, SCHEME, "")
    has_net = rest.startswith("//")
    netloc = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    path = F.when(has_net, F.regexp_extract(rest, r"^//[^/?#]*([^?#]*)", 1)) \
        .otherwise(F.regexp_extract(rest, r"^([^?#]*)", 1))
    domain = F.when(netloc != "", netloc).otherwise(path)
    d = F.regexp_replace(domain, r"www\.", "")
    parts = F.split(d, r"\.", -1)
    n = F.size(parts)
    return (F.when(url.isNull() | (url == "") | (domain == ""), F.lit("web"))
            .when(n > 2, F.element_at(parts, -2))
            .when(n == 2, d)
            .otherwise(F.lit("web")))
