"""Readers for raw logs and typed events.

JSON lines are read as text and parsed into VARIANT, so a malformed line becomes
a row with a parse error instead of failing the job (dead-letter, P10), and the
JSON type of every field can be checked: a number is not accepted as text, a
negative or fractional number not as an unsigned one, text behind the object
not at all.  Field names match in any letter case, absent or null fields read as
zero / empty text, and a line ``null`` is an empty record, like the reference's
zero values.  There is no line-length limit.  A name that occurs twice in one
object fails the line, and unsigned values end at 2^63 - 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import schemas as S
from tidepool.plans.joins import settled

PARSE_ERROR = "invalid json line"

# Integers that may be negative; every other integer field is unsigned.
SIGNED = {"tick", "tick_lower", "tick_upper", "tick_spacing"}


def _zero(t: T.DataType) -> Column:
    if isinstance(t, (T.LongType, T.IntegerType, T.ShortType)):
        return F.lit(0).cast(t)
    if isinstance(t, T.BooleanType):
        return F.lit(False)
    return F.lit("") if isinstance(t, T.StringType) else F.lit(None).cast(t)


def _members(value: Column, path: str = "$") -> Column:
    """A VARIANT object as a map, NULL when it is not an object."""
    return F.try_variant_get(value, path, "map<string,variant>")


def _cased(members: Column) -> Column:
    """Whether some name in the map is not in lower case."""
    return F.coalesce(F.exists(F.map_keys(members), lambda k: k != F.lower(k)), F.lit(False))


def _member(members: Column, cased: Column, name: str) -> Column:
    """The member of that name in any letter case; its lower-case spelling is the last in order and wins."""
    hit = F.filter(F.map_entries(members), lambda e: F.lower(e["key"]) == F.lit(name))
    return F.coalesce(F.try_element_at(members, F.lit(name)), F.when(cased, F.try_element_at(hit, F.lit(-1))["value"]))


def _leaves(schema: T.StructType, path: tuple = ()) -> list:
    """(path, type) of every field at every depth."""
    own = [((*path, f.name), f.dataType) for f in schema.fields]
    return own + [x for at, t in own if isinstance(t, T.StructType) for x in _leaves(t, at)]


def _col(kind: str, at: tuple) -> Column:
    return F.col(_name(kind, at))


def _name(kind: str, at: tuple) -> str:
    """Work column of a field: v its VARIANT, k its JSON type, g the value read, m its members, c cased names, f fits."""
    return "_".join(("", kind, *at))


def _is_int(t: T.DataType) -> bool:
    return isinstance(t, (T.LongType, T.IntegerType, T.ShortType))


def _looked_up(at: tuple, t: T.DataType) -> list:
    """JSON type and value of one field; for an object its members."""
    value = _col("v", at)
    if isinstance(t, T.StructType):
        return [F.when(value.isNull() | F.is_variant_null(value), F.lit("VOID")).otherwise(F.lit("")).alias(_name("k", at)),
                _members(value).alias(_name("m", at))]
    read_as = t.simpleString() if _is_int(t) or isinstance(t, (T.BooleanType, T.ArrayType)) else "string"
    return [F.coalesce(F.schema_of_variant(value), F.lit("VOID")).alias(_name("k", at)),
            F.try_variant_get(value, "$", read_as).alias(_name("g", at))]


def _fits(at: tuple, t: T.DataType) -> Column:
    """Whether the field is absent, null or of the right JSON type."""
    kind = _col("k", at)
    if _is_int(t):
        fits = (kind == "BIGINT") & _col("g", at).isNotNull()
        if at[-1] not in SIGNED:
            fits = fits & (_col("g", at) >= 0)
    elif isinstance(t, T.BooleanType):
        fits = kind == "BOOLEAN"
    elif isinstance(t, T.ArrayType):
        fits = kind.isin("ARRAY<STRING>", "ARRAY<VOID>")
    elif isinstance(t, T.StructType):
        fits = _col("m", at).isNotNull()
        for f in t.fields:
            fits = fits & _col("f", (*at, f.name))
    else:
        fits = kind == "STRING"
    return (kind == "VOID") | F.coalesce(fits, F.lit(False))


def _read(at: tuple, t: T.DataType) -> Column:
    """The value of a field that fits; inside an object names count as they are spelled."""
    if not isinstance(t, T.StructType):
        return _col("g", at)
    built = F.struct(*[F.when(_col("k", (*at, f.name)) != "VOID", _read((*at, f.name), f.dataType)).alias(f.name) for f in t.fields])
    return F.when(_col("c", at), F.from_json(F.to_json(_col("v", at)), t)).otherwise(built)


def parse_json_lines(lines: DataFrame, schema: T.StructType, column: str = "value",
                     soft: tuple = ()) -> DataFrame:
    """Trimmed non-blank lines -> schema columns plus ``_parse_error``.

    A field in ``soft`` does not fail its line: a boolean ``<field>_ok`` says
    whether it was there (``null`` counts as there) and had the right type.

    Every line is parsed once and every field looked up, read and checked once,
    level by level for nested objects; each level is a projection of its own.
    """
    rows = lines.select(F.trim(F.col(column)).alias("_line")).where(F.col("_line") != "")
    # The line stands alone in an array, so that nothing may follow the object.
    rows = rows.withColumn("_a", F.try_parse_json(F.concat(F.lit("["), F.col("_line"), F.lit("]"))))
    alone = F.try_variant_get("_a", "$[1]", "variant").isNull()
    rows = rows.select((F.col("_line") == "null").alias("_empty"), F.when(alone, _members(F.col("_a"), "$[0]")).alias(_name("m", ())))
    rows = rows.withColumn(_name("c", ()), _cased(_col("m", ())))
    leaves = _leaves(schema)
    deepest = max(len(at) for at, _ in leaves)
    for depth in range(1, deepest + 1):
        level = [(at, t) for at, t in leaves if len(at) == depth]
        rows = rows.select("*", *[_member(_col("m", at[:-1]), _col("c", at[:-1]), at[-1]).alias(_name("v", at)) for at, _ in level])
        rows = rows.select("*", *[c for at, t in level for c in _looked_up(at, t)])
        rows = rows.select("*", *[_cased(_col("m", at)).alias(_name("c", at)) for at, t in level if isinstance(t, T.StructType)])
    for depth in range(deepest, 0, -1):
        rows = rows.select("*", *[_fits(at, t).alias(_name("f", at)) for at, t in leaves if len(at) == depth])
    bad = _col("m", ()).isNull() & ~F.col("_empty")
    cols = []
    for f in schema.fields:
        at = (f.name,)
        cols.append(F.when((_col("k", at) != "VOID") & _col("f", at), _read(at, f.dataType)).otherwise(_zero(f.dataType)).alias(f.name))
        if f.name in soft:
            cols.append((_col("v", at).isNotNull() & _col("f", at)).alias(f"{f.name}_ok"))
        else:
            bad = bad | ~_col("f", at)
    return settled(rows.select(*cols, F.when(bad, F.lit(PARSE_ERROR)).alias("_parse_error")))


def read_raw_logs_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Raw-log JSON lines (S2); bad lines carry ``_parse_error`` for the dead-letter sink."""
    return parse_json_lines(spark.read.text(path), S.RAW_LOG)


def read_raw_logs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw logs from a columnar landing table (explicit schema, pushdown-friendly)."""
    if fmt == "jsonl":
        return read_raw_logs_jsonl(spark, path)
    return spark.read.schema(S.RAW_LOG).format(fmt).load(path)


def read_typed_events_jsonl(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    """Typed-event JSON lines (S3).

    Unreadable lines are skipped (``keep_bad`` keeps them with
    ``_parse_error`` for counting, as the reference counts them as failed).
    ``decoded`` is parsed on its own: when it is absent, not an object, or has
    a field of the wrong type, ``decoded_ok`` is false, so that the event
    stays in its window and a swap with it fails; an explicit ``null`` reads
    as an empty payload.
    """
    p = parse_json_lines(spark.read.text(path), S.TYPED_EVENT, soft=("decoded",))
    return p if keep_bad else p.where(F.col("_parse_error").isNull()).drop("_parse_error")
