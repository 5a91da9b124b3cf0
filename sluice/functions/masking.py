"""Column masks ``column:algorithm[:parameter]``. Null stays null."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import workspace


def _text(c: C) -> C:
    return c.cast("string")


def _stars(n: C) -> C:
    return F.repeat(F.lit("*"), n)


def _digits(c: C) -> C:
    return F.regexp_replace(_text(c), r"[^0-9]", "")


def _number(param: str | None, default: float, positive: bool = False) -> float:
    try:
        value = float(param) if param else default
    except ValueError:
        return default
    return default if value == 0 or (positive and value < 0) else value


def sha256(c: C, param=None, kind=None) -> C:
    return F.sha2(_text(c), 256)


def md5(c: C, param=None, kind=None) -> C:
    return F.md5(_text(c))


def hmac(c: C, param=None, kind=None) -> C:
    """HMAC-SHA256 as two nested digests; the padded keys are computed once on the driver."""
    if not param:
        raise ValueError("mask hmac needs a key")
    key = param.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = bytearray(b ^ 0x36 for b in key), bytearray(b ^ 0x5C for b in key)
    digest = F.unhex(F.sha2(F.concat(F.lit(inner), _text(c).cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer), digest), 256)


def partial(c: C, param=None, kind=None) -> C:
    n = int(param) if param and param.isdigit() and int(param) > 0 else 2
    v = _text(c)
    size = F.length(v)
    return F.when(size <= 2 * n, _stars(size)).otherwise(
        F.concat(F.substring(v, 1, n), _stars(size - 2 * n), F.substring(v, -n, n))
    )


def email(c: C, param=None, kind=None) -> C:
    v = _text(c)
    at = F.instr(v, "@")
    local, domain = F.substring(v, F.lit(1), at - 1), F.substring(v, at, F.length(v))
    n = F.length(local)
    hidden = F.when(n <= 2, _stars(n)).otherwise(F.concat(F.substring(local, 1, 1), _stars(n - 2), F.substring(local, -1, 1)))
    return F.when(v == "", v).when(at == 0, partial(c)).otherwise(F.concat(hidden, domain))


def phone(c: C, param=None, kind=None) -> C:
    d = _digits(c)
    return F.when(F.length(d) < 10, _stars(F.length(d))).otherwise(F.concat(F.substring(d, 1, 3), F.lit("-***-****")))


def credit_card(c: C, param=None, kind=None) -> C:
    d = _digits(c)
    n = F.length(d)
    return F.when(n < 12, _stars(n)).otherwise(F.concat(_stars(n - 4), F.substring(d, -4, 4)))


def ssn(c: C, param=None, kind=None) -> C:
    d = _digits(c)
    return F.when(F.length(d) != 9, _stars(F.length(d))).otherwise(F.concat(F.lit("***-**-"), F.substring(d, -4, 4)))


def redact(c: C, param=None, kind=None) -> C:
    return F.lit("REDACTED")


def stars(c: C, param=None, kind=None) -> C:
    return _stars(F.length(_text(c)))


def fixed(c: C, param=None, kind=None) -> C:
    return F.lit("MASKED" if param is None else param)


def first_letter(c: C, param=None, kind=None) -> C:
    v = _text(c)
    return F.when(F.length(v) <= 1, v).otherwise(F.concat(F.substring(v, 1, 1), _stars(F.length(v) - 1)))


def round_to(c: C, param=None, kind=None) -> C:
    step = _number(param, 10.0)
    return (F.round(_text(c).try_cast("double") / step) * step).cast("long")


def bucket(c: C, param=None, kind=None) -> C:
    width = _number(param, 100.0, positive=True)
    lower = F.floor(_text(c).try_cast("double") / width) * int(width)
    return F.concat_ws("-", lower, lower + int(width))


def noise(c: C, param=None, kind=None) -> C:
    """The value and up to ``level`` of its size, up or down; whole numbers stay whole."""
    v = _text(c).try_cast("double")
    size = F.when(v == 0, 1.0).otherwise(F.abs(v))
    out = v + (F.rand() * 2 - 1) * (float(param) if param else 0.1) * size
    return out.cast("long") if isinstance(kind, T.IntegralType) else out


def random_like(c: C, param=None, kind=None) -> C:
    """A random value of the same shape: digits of an integer, size of a float, length of a text."""
    v = _text(c)
    if isinstance(kind, T.IntegralType):
        low = F.pow(F.lit(10.0), F.length(F.regexp_replace(v, "-", "")) - 1)
        return F.floor(low + F.rand() * (low * 9)).cast("long")
    if isinstance(kind, T.FractionalType):
        number = v.try_cast("double")
        return F.rand() * 2 * F.when(number == 0, 1.0).otherwise(F.abs(number))
    lots = F.transform(F.sequence(F.lit(1), F.ceil(F.length(v) / 256)), lambda _: F.randstr(256))
    return F.when(F.length(v) == 0, F.lit("")).otherwise(F.array_join(lots, "").substr(F.lit(1), F.length(v)))


def date_shift(c: C, param=None, kind=None) -> C:
    days = int(param) if param and param.isdigit() and int(param) > 0 else 30
    shift = F.floor(F.rand() * (2 * days + 1)).cast("int") - days
    if isinstance(kind, T.DateType):
        return F.date_add(c, shift)
    moved = _text(c).try_cast("timestamp") + F.make_dt_interval(days=shift)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return moved.cast(kind)
    return F.date_format(moved, "yyyy-MM-dd")


def year_only(c: C, param=None, kind=None) -> C:
    return F.year(_text(c).try_cast("timestamp")).cast("long")


def month_year(c: C, param=None, kind=None) -> C:
    return F.date_format(_text(c).try_cast("timestamp"), "yyyy-MM")


ALGORITHMS: dict[str, Callable] = {
    "hash": sha256, "sha256": sha256, "md5": md5, "hmac": hmac, "email": email, "phone": phone,
    "credit_card": credit_card, "ssn": ssn, "redact": redact, "stars": stars, "fixed": fixed, "partial": partial,
    "first_letter": first_letter, "round": round_to, "range": bucket, "noise": noise, "random": random_like,
    "date_shift": date_shift, "year_only": year_only, "month_year": month_year,
}
#: Masks that need the distinct values of the column.
TOKENS = ("uuid", "sequential")


def parse(spec: str) -> tuple[str, str, str | None]:
    """Column, algorithm and parameter of one mask."""
    parts = spec.split(":", 2)
    if len(parts) < 2 or not parts[0].strip() or parts[1].strip().lower() not in {*ALGORITHMS, *TOKENS}:
        raise ValueError(f"bad mask: {spec!r}")
    return parts[0].strip(), parts[1].strip().lower(), parts[2] if len(parts) == 3 else None


def uuid_token(c: C, salt: str) -> C:
    """A random-looking uuid for each value; equal values get equal ones under one salt."""
    h = F.sha2(F.concat(F.lit(salt), _text(c)), 256)
    part = lambda at, n: F.substring(h, at, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("4"), part(14, 3)), F.concat(F.lit("a"), part(18, 3)), part(21, 12))


def sequential_tokens(df: DataFrame, name: str) -> DataFrame:
    """Values replaced by their number in sorted order, from 1, through a table of the distinct ones.

    The sorted values are written once with their place in their range partition
    (``monotonically_increasing_id`` has the partition in its upper bits); a
    partition's first number is one more than the rows of those before it, so no
    task sees all values. Only the partitions' counts, a row each, meet in one task.
    """
    value = F.col(name).cast("string")
    distinct = df.select(value.alias("_value")).distinct().dropna()
    path = workspace.path(df.sparkSession, "values")
    distinct.orderBy("_value").withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.schema("_value string, _at long").parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    firsts = firsts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    table = placed.join(F.broadcast(firsts), "_part").select("_value", (F.col("_first") + place + 1).alias("_token"))
    out = df.join(table, value == F.col("_value"), "left")
    return out.select(*(F.col("_token").alias(name) if c == name else F.col(c) for c in df.columns))


def mask(df: DataFrame, specs: list[str]) -> DataFrame:
    """``df`` with its columns masked; an unknown column or algorithm is an error."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    by_lower = {c.lower(): c for c in df.columns}
    plain: dict[str, C] = {}
    tokens = []
    for spec in specs:
        name, algorithm, param = parse(spec)
        if name.lower() not in by_lower:
            raise ValueError(f"mask for an unknown column: {name}")
        name = by_lower[name.lower()]
        if algorithm in TOKENS:
            tokens.append((name, algorithm))
        else:
            masked = ALGORITHMS[algorithm](F.col(name), param, kinds[name])
            plain[name] = F.when(F.col(name).isNotNull(), masked)
    df = df.withColumns(plain) if plain else df
    salt = secrets.token_hex(16)  # one per run
    for name, algorithm in tokens:
        if algorithm == "uuid":
            df = df.withColumn(name, F.when(F.col(name).isNotNull(), uuid_token(F.col(name), salt)))
        else:
            df = sequential_tokens(df, name)
    return df
