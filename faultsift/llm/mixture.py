"""Mixing sources to target weights with multinomial shards and index permutations."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultsift.llm.common import SPACE, WORD, importable, mapped, packed, pick, running_start, staged, table, unpacked

# Words in a block and slots in an output shard.
BLOCK = 64
SHARD = 4096
# No source, and so no document, is taken more often.
REPEATS = 3
SEED = 20_240_517
# Documents that share a running sum, on average, and the fewest buckets.
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 64
# Shards that share a running sum.
BUCKET_SHARDS = 1024


@dataclass(frozen=True)
class Share:
    """What a mix takes of one source. ``slots`` blocks are taken of ``blocks``."""

    source: str | None
    size: int
    target: float
    blocks: int
    slots: int


def by_rank(rank: int) -> float:
    """Weights 1, 2, 3, repeating."""
    return float(rank % 3 + 1)


def targets(sizes: list[int], weights: list[float], repeats: float = REPEATS) -> list[float]:
    """Shares the whole size by weight; a source stops at ``repeats`` times its size.

    What a stopped source leaves is shared among the others by weight, until
    none is above its bound.
    """
    out = [0.0] * len(sizes)
    free = [k for k, size in enumerate(sizes) if size > 0 and weights[k] > 0]
    rest = float(sum(sizes))
    while free:
        whole = sum(weights[k] for k in free)
        level = rest / whole
        full = [k for k in free if weights[k] * level > repeats * sizes[k]]
        if not full:
            for k in free:
                out[k] = rest * weights[k] / whole
            break
        for k in full:
            out[k] = float(repeats * sizes[k])
            rest -= out[k]
        free = [k for k in free if k not in set(full)]
    return out


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(
    sized: DataFrame, weight: Callable[[int], float] = by_rank, block: int = BLOCK
) -> list[Share]:
    """The mix of the sources of ``sized`` (source, size): one entry a source.

    Only the total of each source reaches the driver: a mix is configured by
    source, so their number is that of its settings.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in totals]
    out = []
    goal = targets(sizes, [weight(k) for k in range(len(sizes))])
    for row, size, target in zip(totals, sizes, goal):
        blocks = -(-size // block)
        # In blocks of their mean length, so that a short last block is allowed for.
        slots = min(round(target * blocks / size), REPEATS * blocks) if size else 0
        out.append(Share(row["source"], size, target, blocks, slots))
    return out


def _mix_bits(x: np.ndarray) -> np.ndarray:
    """A well-mixing function of 64 bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, count: int, key: np.ndarray | int) -> np.ndarray:
    """Where a pseudorandom permutation of 0..count-1 puts each index.

    A Feistel network over the next even number of bits; results out of range
    go through it again. Nothing is stored, so any task can place any index.
    ``key`` chooses the permutation, for each index if it is an array.
    """
    x = np.asarray(index, "<u8").copy()
    if count <= 1:
        return x.astype("<i8")
    half = np.uint64(max(1, (int(count - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.broadcast_to(np.asarray(key, "<u8"), x.shape)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for step in range(4):
            salt = keys[todo] * np.uint64(4) + np.uint64(step)
            with np.errstate(over="ignore"):
                turn = _mix_bits(right + _mix_bits(salt + np.uint64(0x9E3779B97F4A7C15)))
            left, right = right, left ^ (turn & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= count]
    return x.astype("<i8")


def draws(spark: SparkSession, mix: list[Share], shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, bucket, ord, n): how many slots of each output shard each source gets.

    Every shard draws from a multinomial by the sources' shares, seeded by its
    number, so a task that runs again draws the same.
    """
    importable(spark)
    total = sum(s.slots for s in mix)
    odds = np.array([s.slots for s in mix], float) / max(1, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            rows = []
            for number in numbers.tolist():
                slots = min(shard, total - number * shard)
                drawn = np.random.default_rng([seed, number]).multinomial(slots, odds)
                used = np.flatnonzero(drawn)
                rows.append((np.full(len(used), number), used, drawn[used]))
            at, ords, n = (np.concatenate(c) for c in zip(*rows)) if rows else [np.zeros(0, int)] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype("<i8")) for c in (at, at // BUCKET_SHARDS, ords, n)],
                ["shard", "bucket", "ord", "n"],
            )

    return mapped(spark.range(-(-total // shard)),
        run, "shard long, bucket long, ord long, n long"
    )


def slots(spark: SparkSession, mix: list[Share], shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, slot, ord, block): the block of the source ``ord`` in each output slot.

    The k-th slot of a source takes block k of its permutation, and of another
    one each time the source is through, so no block is taken more than once
    more than another. What a source drew above its number of slots goes to
    the sources that drew too few, so totals meet the targets to the block.
    """
    drawn = staged(draws(spark, mix, shard, seed), "draws")
    counts = {r["ord"]: r["n"] for r in drawn.groupBy("ord").agg(F.sum("n").alias("n")).collect()}
    quota = np.array([s.slots for s in mix], "<i8")
    got = np.array([counts.get(k, 0) for k in range(len(mix))], "<i8")
    above, below = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    above_from = np.cumsum(above) - above
    below_to = np.cumsum(below)
    blocks = np.array([max(1, s.blocks) for s in mix], "<i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, ords, n, rank = (batch[c].to_numpy() for c in ("shard", "ord", "n", "rank"))
            # Slices hold the slots of some 200 entries: memory stays bounded.
            for at in range(0, len(n), 200):
                part = slice(at, at + 200)
                repeat = n[part]
                offset = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
                place = np.repeat(number[part], repeat)
                own, k = np.repeat(ords[part], repeat), np.repeat(rank[part], repeat) + offset
                extra = k >= quota[own]
                spare = above_from[own[extra]] + k[extra] - quota[own[extra]]
                taker = np.searchsorted(below_to, spare, side="right")
                k[extra] = got[taker] + spare - (below_to - below)[taker]
                own[extra] = taker
                index = np.empty(len(k), "<i8")
                for o in np.unique(own).tolist():
                    rows = np.flatnonzero(own == o)
                    turn, at_block = np.divmod(k[rows], blocks[o])
                    key = _mix_bits(
                        np.uint64(seed) + np.uint64(o) * np.uint64(1_000_003) + turn.astype("<u8")
                    )
                    index[rows] = permuted(at_block, int(blocks[o]), key >> np.uint64(8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (place, k, own, index)], ["shard", "rank", "ord", "block"]
                )

    ranked = running_start(drawn, ["ord"], "bucket", ["shard"], "n", "rank")
    made = mapped(ranked, run, "shard long, rank long, ord long, block long")
    # Written, so that Spark knows their real number and does not broadcast them.
    return staged(made, "slots")


def with_start(sized: DataFrame, mix: list[Share]) -> DataFrame:
    """``sized`` with ord, bucket, nth and start: where each row is in its source.

    A source's rows follow each other in pseudorandom order, by buckets of the
    id's hash; ``start`` is the number of words before a row, and (ord, bucket,
    nth) names the row. ``sized`` has doc_id, source, size and row_key.
    """
    spark = sized.sparkSession
    names = spark.createDataFrame([(s.source, k) for k, s in enumerate(mix)], "name string, ord long")
    # One row a source, made of the driver's own list.
    known = sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    buckets = LEAST_BUCKETS + known.count() // BUCKET_ROWS
    # By id and text, so that an id of very many rows, or none, is spread.
    known = known.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(buckets)))
    order = ["doc_id", "row_key"]
    nth = F.row_number().over(Window.partitionBy("ord", "bucket").orderBy(*order))
    return running_start(known.withColumn("nth", nth), ["ord"], "bucket", ["nth"], "size", "start")


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each block that a row of ``placed`` lies in, with its words there as ``part``.

    Rows without words have one row with a null block.
    """
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    own = F.when(F.col("size") > 0, F.sequence(first, last))
    spread = placed.withColumn("block", F.explode_outer(own))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return spread.withColumns({"begin": begin, "part": end - begin})


def sized_rows(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, source, size, row_key, ...) of every row; a null text has size 0."""
    return pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        F.xxhash64("text").alias("row_key"),
        *more,
    )


def mixed(
    docs: DataFrame, weight: Callable[[int], float] = by_rank, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """(doc_id, row_key, source, size, source_size, target, taken) of every row of ``docs``.

    ``taken`` counts the words of a row in the blocks of the mix, repeats
    included; it is at most three times its size. Sources weigh by their rank
    by code point, null last. Rows without words are kept and give nothing.
    Repeated rows count each. A table without rows gives none. Reruns over the
    same rows agree. Other columns are ignored.
    """
    spark = docs.sparkSession
    sized = staged(sized_rows(docs), "sizes")
    mix = shares(sized, weight, block)
    times = slots(spark, mix, seed=seed).groupBy("ord", "block").agg(F.count("*").alias("times"))
    parts = pieces(with_start(sized, mix), block)
    parts = parts.select("ord", "bucket", "nth", "doc_id", "row_key", "size", "block", "part")
    rows = ["ord", "bucket", "nth", "doc_id", "row_key", "size"]
    words = F.coalesce(F.sum(F.col("part") * F.col("times")), F.lit(0)).cast("long")
    taken = parts.join(times, ["ord", "block"], "left").groupBy(*rows).agg(words.alias("taken"))
    known = spark.createDataFrame(
        [(k, s.source, s.size, s.target) for k, s in enumerate(mix)],
        "ord long, source string, source_size long, target double",
    )
    return taken.join(F.broadcast(known), "ord").select(
        "doc_id", "row_key", "source", "size", "source_size", "target", "taken"
    )


def mixed_blocks(
    docs: DataFrame, weight: Callable[[int], float] = by_rank, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """(shard, rank, source, block, text): the output itself, one row a slot.

    A block holds ``block`` words of its source, joined by one space (the last
    block of a source may be shorter).
    """
    spark = docs.sparkSession
    sized = staged(sized_rows(docs, "text"), "texts")
    mix = shares(sized, weight, block)
    parts = pieces(with_start(sized, mix).where("size > 0"), block)
    words = F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "")
    own = F.slice(words, (F.col("begin") - F.col("start") + 1).cast("int"), F.col("part").cast("int"))
    parts = parts.select("ord", "block", F.struct("begin", own.alias("words")).alias("piece"))
    # A block has at most as many pieces as words.
    made = parts.groupBy("ord", "block").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    made = made.select(
        "ord", "block", F.array_join(F.flatten(F.col("pieces.words")), " ").alias("text")
    )
    names = spark.createDataFrame([(k, s.source) for k, s in enumerate(mix)], "ord long, source string")
    placed = slots(spark, mix, seed=seed).join(made, ["ord", "block"])
    return placed.join(F.broadcast(names), "ord").select("shard", "rank", "source", "block", "text")


def resampled(docs: DataFrame, weight: Callable[[int], float] = by_rank) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its words are taken, on average.

    A row taken 1.4 times its size comes once, and a second time with a chance
    of 0.4 drawn from its id. Rows without words stay as they are. Repeated
    rows are one row that may be taken more often. All columns are returned.
    """
    ids = ["doc_id", "row_key", "source"]
    share = mixed(docs, weight).groupBy(*ids).agg(
        F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.count("*").alias("n")
    )
    chance = F.pmod(F.xxhash64("doc_id", "row_key", F.lit(SEED)), F.lit(1 << 20)) / (1 << 20)
    per_row = F.col("size") / F.col("n")
    copies = F.when(per_row > 0, F.floor(F.col("taken") / per_row + chance)).otherwise(F.lit(1))
    share = share.select(*[F.col(c).alias(f"its_{c}") for c in ids], copies.cast("int").alias("copies"))
    share = share.where("copies > 0")
    rows = packed(docs, "doc_id", "source", "text").select(
        "doc",
        "rest",
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("row_key"),
        F.col("source").cast("string").alias("source"),
    )
    rows = rows.join(share, [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in ids])
    only = Window.partitionBy(*ids).orderBy("rest")
    rows = rows.withColumn("nth", F.row_number().over(only)).where("nth = 1")
    return unpacked(rows.withColumn("again", F.explode(F.sequence(F.lit(1), "copies"))), docs)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")
