"""Types that keep every value.

A value is classified by what accepts it *without loss*: an integer by a
successful cast, a fraction by the digits a double keeps, a date by being a day
of the calendar, a point by its ranges. The classes are bits, so the least upper
bound of a column is one ``bit_or`` aggregate, together with the most digits
before and after the point; the bound is read off those three numbers:

    int < float < decimal(p, s) < str       (numbers, by what they need)
    date, geo_point, str                    (alone)
    anytype                                 (nothing, or a mixture of these)

``decimal(p, s)`` holds columns whose digits a double would lose; beyond 38
digits, or with exponents among such digits, numbers stay text. No value of a
column is changed by a cast to the type inferred for it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The shapes of numbers, dates and points in text.
INT_RE = r"^[+-]?[0-9]+$"
FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
GEO_RE = r"^-?[0-9]+(\.[0-9]+)?,-?[0-9]+(\.[0-9]+)?$"
#: Digits that every double keeps, and its smallest full-precision magnitude.
DOUBLE_DIGITS, DOUBLE_LEAST = 15, 2.3e-308
#: Most digits of a decimal.
DECIMAL_DIGITS = 38

#: The classes of a value.
SHORT, LONG, FLOAT, EXACT, HUGE, DATE, GEO, TEXT, EXPONENT = (1 << i for i in range(9))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def digits(s: Column) -> dict[str, Column]:
    """Of a number in text: its digits before and after the point, the significant ones, and whether it has an exponent."""
    bare = F.lower(F.ltrim(s, F.lit("+-")))
    mantissa = F.substring_index(bare, "e", 1)
    whole = F.substring_index(mantissa, ".", 1)
    part = F.rtrim(F.when(F.contains(mantissa, F.lit(".")), F.substring_index(mantissa, ".", -1)).otherwise(""), F.lit("0"))
    return {"before": F.length(F.ltrim(whole, F.lit("0"))), "after": F.length(part),
            "significant": F.length(F.ltrim(F.concat(whole, part), F.lit("0"))), "exponent": F.contains(bare, F.lit("e"))}


def keeps_double(s: Column) -> Column:
    """Whether a number in text is kept by a double: its digits fit, or it is what a double prints."""
    d, value = digits(s), s.try_cast("double")
    magnitude = F.abs(value)
    inside = (magnitude >= DOUBLE_LEAST) & (magnitude < float("inf"))
    return ((d["significant"] <= DOUBLE_DIGITS) & ((d["significant"] == 0) | inside)) | (inside & (value.cast("string") == s))


def is_point(s: Column) -> Column:
    """Whether a text is 'latitude,longitude' in range."""
    return s.rlike(GEO_RE) & (F.abs(F.substring_index(s, ",", 1).try_cast("double")) <= 90) & (
        F.abs(F.substring_index(s, ",", -1).try_cast("double")) <= 180)


def is_date(s: Column) -> Column:
    """Whether a text is a day of the calendar, with or without a time of at most six fractional digits."""
    return s.rlike(DATE_RE) & s.try_cast("timestamp_ntz").isNotNull()


def classified(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``bits``, ``before`` and ``after`` of a text column; bits are null for a null.

    A shape is matched once and each part of a number is cut out once: every step is a projection of its own, as
    an expression that names a step several times would compute it each time.
    """
    s, keep = F.col(text), list(df.columns)
    df = df.select(*keep, s.rlike(FLOAT_RE).alias("_number"), F.lower(F.ltrim(s, F.lit("+-"))).alias("_bare"), (F.length(s) > DOUBLE_DIGITS).alias("_long"))
    number, bare = F.col("_number"), F.col("_bare")
    df = df.withColumns({"_mantissa": F.when(number, F.substring_index(bare, "e", 1)), "_exponent": number & F.contains(bare, F.lit("e")),
                         "_point": number & F.contains(bare, F.lit("."))})
    mantissa, exponent, point = F.col("_mantissa"), F.col("_exponent"), F.col("_point")
    df = df.withColumns({"_whole": F.substring_index(mantissa, ".", 1),
                         "_part": F.rtrim(F.when(F.contains(mantissa, F.lit(".")), F.substring_index(mantissa, ".", -1)).otherwise(""), F.lit("0")),
                         "_few": number & ~exponent & ~F.col("_long")})
    whole, part, few = F.col("_whole"), F.col("_part"), F.col("_few")
    df = df.withColumns({"before": F.when(number, F.length(F.ltrim(whole, F.lit("0")))), "after": F.when(number, F.length(part)),
                         "_significant": F.when(number & ~few, F.length(F.ltrim(F.concat(whole, part), F.lit("0")))),
                         "_value": F.when(number & ~few & (exponent | point), s.try_cast("double"))})
    significant, magnitude = F.col("_significant"), F.abs(F.col("_value"))
    inside = (magnitude >= DOUBLE_LEAST) & (magnitude < float("inf"))
    keeps = ((significant <= DOUBLE_DIGITS) & ((significant == 0) | inside)) | (inside & (F.col("_value").cast("string") == s))
    plain = F.when(F.col("before") + F.col("after") <= DECIMAL_DIGITS, EXACT).otherwise(HUGE)
    bits = (F.when(s.isNull(), F.lit(None))
            .when(number & ~point & ~exponent, F.when(~F.col("_long"), SHORT).when(s.try_cast("bigint").isNull(), plain)
                  .when(significant <= DOUBLE_DIGITS, SHORT).otherwise(LONG))
            .when(number, F.when(few, FLOAT).when(keeps, F.when(exponent, FLOAT | EXPONENT).otherwise(FLOAT)).when(exponent, HUGE).otherwise(plain))
            .when(is_date(s), DATE).when(is_point(s), GEO).otherwise(TEXT)).cast("int")
    return df.select(*keep, bits.alias("bits"), "before", "after")


def bound(bits: Column, before: Column, after: Column) -> Column:
    """The name of the least upper bound of the classes in ``bits``."""
    def within(classes: int) -> Column:
        return bits.bitwiseAND(F.lit(~classes & 511)) == 0
    p = F.greatest(before + after, F.lit(1))
    numbers = SHORT | LONG | FLOAT | EXACT | HUGE | EXPONENT
    return (F.when(F.coalesce(bits, F.lit(0)) == 0, "anytype")
            .when(within(SHORT | LONG), "int")
            .when(within(SHORT | FLOAT | EXPONENT), "float")
            .when(within(SHORT | LONG | FLOAT | EXACT) & (p <= DECIMAL_DIGITS), F.concat(F.lit("decimal("), p.cast("string"), F.lit(","), after.cast("string"), F.lit(")")))
            .when(within(numbers), "str")
            .when(bits == DATE, "date").when(bits == GEO, "geo_point")
            .when(within(TEXT | HUGE), "str")
            .otherwise("anytype"))


def _own_kind(dt: T.DataType) -> str | None:
    """The kind of a typed column; None for text, which is decided from its values."""
    if isinstance(dt, T.StringType):
        return None
    if isinstance(dt, T.IntegralType):
        return "int"
    if isinstance(dt, T.DecimalType):
        return f"decimal({dt.precision},{dt.scale})"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "anytype" if isinstance(dt, T.VariantType) else "str"


def infer_types(df: DataFrame) -> DataFrame:
    """Per column the least type that keeps every value: (column, type, n_nonnull, max_len).

    Text columns are typed by their values, others keep the kind of their type;
    a column without values is ``anytype``. Each value becomes a narrow row
    (column, text) inside its task, is classified there by compiled code, and
    one hash aggregate over a handful of groups is partial in every task: a few
    numbers per column are shuffled, and the plan does not grow with the table's
    width.
    """
    fields = df.schema.fields
    own = [_own_kind(f.dataType) for f in fields]
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k is None).alias("open"), F.col(_q(f.name)).cast("string").alias("s"))
                       for i, (f, k) in enumerate(zip(fields, own))])
    long = df.select(F.explode(values).alias("r")).select("r.i", F.length("r.s").alias("l"), F.when(F.col("r.open"), F.col("r.s")).alias("s"))
    counted = classified(long, "s").groupBy("i").agg(F.count("l").alias("n"), F.max("l").alias("l"), F.bit_or("bits").alias("b"),
                                                     F.max("before").alias("p"), F.max("after").alias("a"))
    # a row for every column, also of an empty table
    named = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f.name).alias("column"), F.lit(k).cast("string").alias("own"))
                      for i, (f, k) in enumerate(zip(fields, own))])
    columns = df.sparkSession.range(1).select(F.explode(named).alias("r")).select("r.*")
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    kind = F.when(n == 0, "anytype").when(F.col("own").isNotNull(), F.col("own")).otherwise(bound(F.col("b"), F.col("p"), F.col("a")))
    return columns.join(counted, "i", "left").select("column", kind.alias("type"), n.alias("n_nonnull"), F.col("l").cast("bigint").alias("max_len"))


# ---- B4: which values a mapped type refuses ---------------------------------------

def refusal(s: Column, spark_type: str, mapped: str) -> Column:
    """Why a mapped type cannot keep a text; null where it can (or the text is null)."""
    number = s.rlike(FLOAT_RE)
    if mapped == "geo_point":
        why = F.when(~s.rlike(GEO_RE), "not a point").when(~is_point(s), "out of range")
    elif spark_type == "timestamp_ntz":
        why = F.when(~s.rlike(DATE_RE), "not a date").when(s.try_cast("timestamp_ntz").isNull(), "not in the calendar")
    elif spark_type == "bigint":
        why = F.when(~s.rlike(INT_RE), F.when(number, "loses digits").otherwise("not a number")).when(s.try_cast("bigint").isNull(), "out of range")
    elif spark_type == "double":
        why = F.when(~number, "not a number").when(F.abs(s.try_cast("double")) == float("inf"), "out of range").when(~keeps_double(s), "loses digits")
    elif spark_type.startswith("decimal("):
        scale = int(spark_type[8:-1].split(",")[1])
        why = F.when(~number, "not a number").when(digits(s)["exponent"] | (digits(s)["after"] > scale), "loses digits").when(
            s.try_cast(spark_type).isNull(), "out of range")
    elif spark_type in ("string", "binary"):
        return F.lit(None).cast("string")
    else:
        why = F.when(s.try_cast(spark_type).isNull(), F.lit(f"not a {spark_type}"))
    return F.when(s.isNotNull(), why)


def rejects_of(df: DataFrame, schema: Mapping[str, tuple[str, str]]) -> Column:
    """All refusals of a row: array of (column, value, reason). Columns of one type are judged by one lambda."""
    by_type: dict[tuple[str, str], list[str]] = {}
    for c in df.columns:
        if c in schema:
            by_type.setdefault(schema[c], []).append(c)

    def refused(kind: tuple[str, str], columns: list[str]) -> Column:
        values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("string").alias("value")) for c in columns])
        judged = F.transform(values, lambda r: F.struct(r["column"].alias("column"), r["value"].alias("value"), refusal(r["value"], *kind).alias("reason")))
        return F.filter(judged, lambda r: r["reason"].isNotNull())
    none = F.array().cast("array<struct<column:string,value:string,reason:string>>")
    return F.concat(none, *[refused(kind, columns) for kind, columns in by_type.items()])
