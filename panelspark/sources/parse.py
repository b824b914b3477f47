"""Scalar rules of ingestion, as column functions. Text that cannot be read becomes missing, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_float(c: Column, default: float | None = None) -> Column:
    """A number, or the default for null, empty, unreadable text and NaN."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.coalesce(F.when(~F.isnan(x), x), F.lit(default).cast("double"))


def safe_int(c: Column, default: int | None = None) -> Column:
    """The whole part of a number, or the default."""
    x = safe_float(c)
    return F.coalesce(F.when(F.abs(x) < 9.2e18, F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))).cast("long"), F.lit(default).cast("long"))


def safe_text(c: Column, length: int | None = None) -> Column:
    """Trimmed text, empty for null, cut to a length."""
    t = F.coalesce(F.trim(c.cast("string")), F.lit(""))
    return F.substring(t, 1, length) if length else t


def keep_if_number(c: Column) -> Column:
    """Text of a signal; missing where it reads as NaN."""
    return F.when(F.lower(F.trim(c)) != "nan", c)


def coerce_all(df: DataFrame, text: list[str]) -> DataFrame:
    """The listed columns as text, all others as numbers."""
    return df.select(*((F.col(c).cast("string") if c in text else safe_float(F.col(c))).alias(c) for c in df.columns))


def compact_date(c: Column) -> Column:
    """yyyyMMdd, yyyy-MM-dd, either with a time behind a blank or T."""
    head = F.split(F.split(F.trim(c.cast("string")), " ")[0], "T")[0]
    return F.coalesce(F.when(F.length(head) == 8, F.try_to_timestamp(head, F.lit("yyyyMMdd")).cast("date")), F.when(F.length(head) == 10, F.try_to_timestamp(head, F.lit("yyyy-MM-dd")).cast("date")))


def iso_timestamp(c: Column) -> Column:
    """The first of several ISO forms that fits; a trailing Z is UTC."""
    t = F.regexp_replace(F.trim(c), "Z$", "")
    forms = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "yyyyMMdd")
    return F.coalesce(*(F.try_to_timestamp(t, F.lit(f)) for f in forms))


def epoch_millis(c: Column) -> Column:
    return F.timestamp_millis(safe_int(c))


def exchange_of(code: Column) -> Column:
    """Exchange by the suffix of a code."""
    return F.when(code.endswith(".SH"), "SSE").when(code.endswith(".SZ"), "SZSE").when(code.endswith(".BJ"), "BSE")


#: Pairs of coins and the store's symbols for them.
SYMBOLS = {"BTC/USDT": "BTCUSDT", "ETH/USDT": "ETHUSDT", "SOL/USDT": "SOLUSDT", "BNB/USDT": "BNBUSDT", "DOGE/USDT": "DOGEUSDT"}


def symbol_of(pair: Column, known: dict[str, str] | None = None) -> Column:
    """The store's symbol of a pair: the known one, else the pair without its slash."""
    out = F.replace(pair, F.lit("/"), F.lit(""))
    for name, symbol in (SYMBOLS if known is None else known).items():
        out = F.when(pair == name, symbol).otherwise(out)
    return out


def minutes_since_open(clock: Column) -> Column:
    """HHMMSS (as a number or text) to minutes after 09:30; seconds are the fraction."""
    t = F.lpad(safe_int(clock).cast("string"), 6, "0")
    part = lambda at: F.substring(t, at, 2).try_cast("int")
    return part(1) * 60 + part(3) + part(5) / 60 - 570


def json_list(c: Column) -> Column:
    """A list of texts out of JSON text; also where the list was encoded twice."""
    once = F.from_json(c, T.ArrayType(T.StringType()))
    inner = F.from_json(F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v"), T.ArrayType(T.StringType()))
    return F.coalesce(once, inner)


def first_number(c: Column) -> Column:
    """First element of a JSON list as a number."""
    return safe_float(F.get(json_list(c), 0))


def melt(df: DataFrame, ids: list[str], name: str = "sub_index", value: str = "value") -> DataFrame:
    """Wide to long; cells without a number are dropped."""
    wide = df.select(*ids, *(safe_float(F.col(c)).alias(c) for c in df.columns if c not in ids))
    return wide.unpivot(ids, [c for c in df.columns if c not in ids], name, value).filter(F.col(value).isNotNull())


def parallel_arrays(df: DataFrame, column: str, labels: str = "category", data: str = "data") -> DataFrame:
    """{labels: [..], data: {name: [..]}} to (name, label, value); formulas, empty and unreadable cells are dropped."""
    shape = T.StructType([T.StructField(labels, T.ArrayType(T.StringType())), T.StructField(data, T.MapType(T.StringType(), T.ArrayType(T.StringType())))])
    parsed = df.select(F.from_json(column, shape).alias("j")).select(F.col(f"j.{labels}").alias("l"), F.explode(f"j.{data}").alias("name", "v"))
    cells = parsed.select("name", "l", F.posexplode("v").alias("at", "cell"))
    return cells.select("name", F.get("l", F.col("at")).alias("label"), safe_float(F.when(~F.col("cell").startswith("="), F.col("cell"))).alias("value")).filter("label is not null and value is not null")


def tagged_union(feeds: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    out = None
    for name, df in feeds.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def validated(df: DataFrame, required: list[str], numeric: list[str] | None = None) -> DataFrame:
    """``df`` with an array ``errors``: missing required fields and numbers that cannot be read. Empty text is missing."""
    checks = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(f"{c} is missing")) for c in required]
    checks += [F.when(F.col(c).isNotNull() & safe_float(F.col(c)).isNull(), F.lit(f"{c} is not a number")) for c in numeric or []]
    return df.withColumn("errors", F.filter(F.array(*checks), lambda e: e.isNotNull()))


def with_raw(df: DataFrame) -> DataFrame:
    """The whole record as JSON text beside its columns."""
    return df.withColumn("raw_json", F.to_json(F.struct("*")))
