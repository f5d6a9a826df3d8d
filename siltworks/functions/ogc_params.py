"""Default parameters of OGC requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters as (name, type, format), by service with version and by request.
COMMON = (
    ("service", "string", ""),
    ("request", "string", ""),
    ("version", "string", ""),
)
DEFAULTS: dict[str, dict[str, tuple[tuple[str, str, str], ...]]] = {
    "WMS111": {
        "GETCAPABILITIES": (),
        "GETMAP": (
            ("format", "string", ""),
            ("layers", "string", "comma-delimited string"),
            ("bbox", "string", "minx,miny,maxx,maxy"),
            ("height", "int", ""),
            ("width", "int", ""),
            ("styles", "string", ""),
            ("srs", "string", ""),
            ("transparent", "string", ""),
            ("bgcolor", "hexadecimal", ""),
            ("elevation", "string", ""),
            ("time", "string", ""),
        ),
        "GETFEATUREINFO": (
            ("info_format", "string", ""),
            ("feature_count", "int", ""),
        ),
    },
    "WMS130": {},
    "WFS100": {
        "GETCAPABILITIES": (),
        "DESCRIBEFEATURETYPE": (
            ("typename", "string", ""),
            ("format", "string", ""),
        ),
        "GETFEATURE": (
            ("typename", "string", ""),
            ("format", "string", ""),
            ("bbox", "string", "minx,miny,maxx,maxy"),
            ("propertyname", "string", ""),
            ("featureversion", "string", ""),
            ("featureid", "string", ""),
            ("filter", "string", ""),
            ("maxfeatures", "int", ""),
        ),
    },
    "WFS110": {
        "GETCAPABILITIES": (),
    },
    "WCS100": {},
}


def default_params(service: Column, version: Column, request: Column) -> Column:
    """array<struct<name, type, format>> of a request's parameters, the common ones first; null for unknown services."""
    key = F.concat(F.upper(service), F.replace(version, F.lit("."), F.lit("")), F.lit("/"), F.upper(request))

    def of(specs) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("name", "type", "format"), s)]) for s in specs])

    out = F.when(F.lit(False), of(COMMON))
    for s, methods in DEFAULTS.items():
        for m, specs in methods.items():
            out = out.when(key == f"{s}/{m}", of((*COMMON, *specs)))
        out = out.when(F.substring_index(key, "/", 1) == s, of(COMMON))
    return out
