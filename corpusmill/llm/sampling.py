"""Reproducible sample stable as data grows (problem 6): a Feistel permutation of the identifiers.

An identifier is a number of a fixed domain of 2^128: its 32 hexadecimal digits where it starts with such, else
the digits of its MD5. What follows the digits (a segment number, say) and the source go into the round keys,
so each source and segment has its own permutation. Each is a bijection, so no two identifiers get one place.
An identifier is selected if its place lies under rate x 2^128. That depends on nothing but the identifier, so
a sample is the same in any run and partitioning, keeps its members when rows are added, and a sample of a
smaller rate lies within that of a larger one. There is no shuffle but the final distinct.

The rounds use only products below 2^63, so they run inside generated code and can be repeated in other SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Fixed multipliers and offsets of the round functions: of each round one for either half.
MULTIPLIERS = tuple((2654435761 * (2 * i + 1)) % (1 << 30) | 1 for i in range(1, 2 * ROUNDS + 1))
OFFSETS = tuple((2246822519 * (2 * i + 1)) % (1 << 31) for i in range(1, 2 * ROUNDS + 1))
_LOW = (1 << 32) - 1


def _mix(x: Column, key: Column, m: Column, o: Column) -> Column:
    """32 bits of 32 bits, by products below 2^63."""
    y = x.bitwiseXOR(key) * m + o
    y = F.shiftright(y, 17).bitwiseAND(F.lit(_LOW))
    return F.shiftright((y * m + o).bitwiseAND(F.lit((1 << 55) - 1)), 23)


def limb(digits: Column, k: int) -> Column:
    """The k-th 32 bits of a string of hexadecimal digits."""
    return F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long")


def with_place(df: DataFrame, id_col: str = "document_id", source: str = "source", seed: int = 0) -> DataFrame:
    """df with `sample_place`, the upper 62 bits of the identifier's place; null for a null identifier.

    The identifier is four limbs of 32 bits. In each round two of them change the other two, and all move on
    by one. The rounds are a fold over an array, so the expression stays small.
    """
    ident = F.col(id_col).cast("string")
    regular = F.regexp_like(ident, F.lit("^[0-9a-f]{32}"))
    digits = F.when(regular, F.substring(ident, 1, 32)).otherwise(F.md5(ident))
    rest = F.when(regular, F.substring(ident, 33, 1 << 20)).otherwise(F.lit(""))
    tweak = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(source), F.lit("")), rest))
    long = lambda x: F.lit(x).cast("long")
    rounds = F.array(*(F.struct(*(long(v).alias(n) for n, v in (("m", MULTIPLIERS[2 * r]), ("o", OFFSETS[2 * r]), ("m2", MULTIPLIERS[2 * r + 1]), ("o2", OFFSETS[2 * r + 1])))) for r in range(ROUNDS)))
    start = F.struct(*(limb(digits, k).alias(n) for k, n in enumerate("abcd")), *(limb(tweak, k).alias(n) for k, n in enumerate("wxyz")))

    def step(s: Column, r: Column) -> Column:
        return F.struct(
            s["b"].bitwiseXOR(_mix(s["a"], s["w"], r["m"], r["o"])).alias("a"), s["c"].alias("b"),
            s["d"].bitwiseXOR(_mix(s["c"], s["x"], r["m2"], r["o2"])).alias("c"), s["a"].alias("d"),
            s["x"].alias("w"), s["y"].alias("x"), s["z"].alias("y"), s["w"].alias("z"),
        )

    place = F.aggregate(rounds, start, step, lambda s: s["a"] * long(1 << 30) + F.shiftright(s["b"], 2))
    return df.withColumn("sample_place", F.when(ident.isNotNull(), place))


def stable_sample(df: DataFrame, rate: float | dict[str, float], id_col: str = "document_id", source: str = "source", seed: int = 0) -> DataFrame:
    """(document_id, source) of the selected documents, each once.

    rate: one for all sources, or by source as stored (others: 0). Rates outside 0 to 1 count as 0 or 1.
    Null identifiers are never selected; a null source is a source of its own.
    """
    bound = lambda r: int(max(0.0, min(1.0, r)) * (1 << 62))
    d = df.select(F.col(id_col).alias("document_id"), F.col(source).alias("source"))
    if isinstance(rate, dict):
        under = F.lit(0).cast("long")
        for s, r in rate.items():
            under = F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(bound(r))).otherwise(under)
    else:
        under = F.lit(bound(rate))
    placed = with_place(d, "document_id", "source", seed)
    return placed.where(F.col("sample_place") < under).select("document_id", "source").distinct()
