"""Filling fixed-capacity containers with documents by best-two-fit.

A document's size is its number of tokens. Documents longer than a container are cut into full
pieces and a rest; nothing else is split. Full pieces fill a container each. The other pieces
are spread by a hash over packing groups of bounded size (the number of groups follows from the
number of pieces) and each group is packed on its own, which leaves at most about one
container a group less full than it could be.

Within a group a container is first filled greedily with the largest piece that still fits.
While room is left, its smallest piece is replaced with two unpacked pieces that together fit
the expanded gap more tightly, the tightest such pair first. Only the number of pieces of each
length matters for this, kept as a bit set of the lengths in stock.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.session import cut

#: Where the public tokenizer's ranks lie on every worker; a parameter, never a copy.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces that one task packs together, about.
GROUP = 20_000
# Fixed value: the published pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str, out: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``df`` without ``text`` and with its number of tokens; null and empty texts have none."""
    keep = [c for c in df.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text) + f", `{out}` long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(text).to_pylist()]
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*keep, out])

    return df.select(*keep, text).mapInArrow(run, schema)


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(container, slot) of each length; lengths lie in 1..capacity."""
    order = np.argsort(lengths, kind="stable")[::-1]
    stock: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        stock.setdefault(int(lengths[i]), []).append(i)
    bits = sum(1 << n for n in stock)
    container, slot = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int32)

    def at_most(x: int) -> int:
        """The largest length in stock up to x, or 0."""
        return (bits & ((1 << (x + 1)) - 1)).bit_length() - 1 if x > 0 and bits & ((1 << (x + 1)) - 1) else 0

    def take(n: int) -> int:
        nonlocal bits
        i = stock[n].pop()
        if not stock[n]:
            del stock[n]
            bits ^= 1 << n
        return i

    def put(n: int, i: int) -> None:
        nonlocal bits
        stock.setdefault(n, []).append(i)
        bits |= 1 << n

    def best_two(least: int, most: int) -> tuple[int, int] | None:
        """The pair with the greatest sum above ``least`` and up to ``most``."""
        best, pair, a = least, None, at_most(most - 1)
        while a and 2 * a > best:
            b = at_most(min(a, most - a))
            if b == a and len(stock[a]) < 2:
                b = at_most(a - 1)
            if b and a + b > best:
                best, pair = a + b, (a, b)
                if best == most:
                    break
            a = at_most(a - 1)
        return pair

    k = 0
    while bits:
        gap, inside = capacity, []
        while n := at_most(gap):
            inside.append((n, take(n)))
            gap -= n
        while gap and inside:
            small, i = inside[-1]
            pair = best_two(small, small + gap)
            if pair is None:
                break
            inside.pop()
            inside += [(n, take(n)) for n in pair]
            put(small, i)
            gap += small - sum(pair)
            inside.sort(reverse=True)
        for s, (_, i) in enumerate(inside):
            container[i], slot[i] = k, s
        k += 1
    return container, slot


def fill_containers(sizes: DataFrame, key: str, size: str, capacity: int, group: int = GROUP) -> DataFrame:
    """(key, piece, start, n_tokens, container, slot): where each piece of each item goes.

    ``container`` is unique over all groups; ``slot`` orders the pieces in it. Items of size
    zero or null have one row without a container. Items with equal keys are packed as separate
    items. An empty input gives an empty result.
    """
    # Two numbers an item, kept, so that counting and both branches don't measure the texts again.
    rows = cut(sizes.select(F.col(key).alias("k"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n")), "sizes")
    last = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / capacity))
    count = rows.agg(F.sum(last + 1)).first()[0] or 0
    groups = max(1, -(-count // group))
    parts = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("start", F.col("piece") * capacity)
    parts = parts.withColumn("n", F.least(F.col("n") - F.col("start"), F.lit(capacity)))
    parts = parts.withColumn("g", F.pmod(F.xxhash64("k", "piece"), F.lit(groups)).cast("int"))
    kind = f"k {dict(parts.dtypes)['k']}, piece long, start long, n long, container long, slot int"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "k", "piece"], ascending=[False, True, True], ignore_index=True)
        place, slot = pack(pdf["n"].to_numpy(), capacity)
        pdf["container"], pdf["slot"] = place + (np.int64(pdf["g"].iloc[0]) << 32), slot
        return pdf[["k", "piece", "start", "n", "container", "slot"]]

    packed = parts.where(F.col("n") > 0).groupBy("g").applyInPandas(run, kind)
    empty = parts.where(F.col("n") <= 0).select("k", "piece", "start", "n", F.lit(None).cast("long").alias("container"), F.lit(None).cast("int").alias("slot"))
    return packed.unionByName(empty).select(F.col("k").alias(key), "piece", "start", F.col("n").alias("n_tokens"), "container", "slot")


def fill_report(placed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, and the share of their room that is filled."""
    used = placed.agg(F.count_distinct("container").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return used.withColumn("filled", F.try_divide(F.col("n_tokens"), F.col("n_containers") * capacity))
