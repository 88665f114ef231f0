"""Relations of the engine. ``rank`` is data: the order of rows in a table never means anything."""

from pyspark.sql import types as T

NASI, ARI = "nasi", "ari"
ALL, SKK_ONLY, SEARCH_ONLY = "all", "skk", "migemo"
GIVEN, GENERATED = "upstream-provided", "rule-generated"

_S, _L, _I, _A = T.StringType(), T.LongType(), T.IntegerType(), T.ArrayType(T.StringType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: What every reader yields. rank: ordinal of the row in its source, counted before any row is rejected.
PARSED = _struct(("source", _S), ("rank", _L), ("reading", _S), ("surface", _S), ("pos", _S), ("kind", _S), ("scope", _S), ("cost", _I), ("pri", _A), ("inf", _A), ("confidence", _S))
#: The merged relation; one row per (reading, surface, source, kind).
ENTRIES = _struct(("reading", _S), ("surface", _S), ("source", _S), ("kind", _S), ("scope", _S), ("rank", _L), ("cost", _I), ("pri", _A), ("pos", _S), ("original_reading", _S), ("confidence", _S), ("inf", _A))
COSTS = _struct(("reading", _S), ("surface", _S), ("source", _S), ("cost", _I))
CLICKS = _struct(("surface", _S), ("source", _S), ("clicks", _L))
SOURCES = _struct(("id", _S), ("format", _S), ("metadata", _S), ("ordinal", _I))
ENTRY_KEY = ["reading", "surface", "source", "kind"]
