"""Mixing sources to target weights: token blocks drawn per shard through index permutations."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.llm.tokenizer import VOCABULARY, with_ids
from pedalmill.session import cut, spread

#: Tokens of a block.
BLOCK_TOKENS = 256
#: Documents of a part; the running token counts of a source are made in so many parts that, if all documents were of
#: one source, a part would have about as many.
CHUNK_DOCS = 50_000
#: Slots of an output shard, unless the mixture would then have more than MAX_SHARDS.
SHARD_SLOTS, MAX_SHARDS = 1024, 4096
#: Sources that a target table may list.
MAX_SOURCES = 10_000


@dataclass
class Plan:
    """What is drawn from a source: ``slots`` blocks out of ``blocks``, in passes of one permutation each."""

    source: str
    share: float
    repeats: int
    tokens: int
    blocks: int
    slots: int


def plan_slots(targets: list[tuple[str, float, int]], tokens: dict[str, int], block: int = BLOCK_TOKENS, total: int | None = None) -> list[Plan]:
    """Slots of every source. Shares are taken among the sources that have tokens; the mixture is as large as
    every share and cap allow, or of ``total`` tokens where that is less. So a source never gives more than
    ``repeats`` times its blocks, and none is short of its share by more than half a block."""
    live = [(s, w, r) for s, w, r in targets if w > 0 and r > 0 and tokens.get(s, 0) > 0]
    whole = sum(w for _, w, _ in live)
    most = min((tokens[s] * r / (w / whole) for s, w, r in live), default=0.0)
    size = most if total is None else min(float(total), most)
    plans = []
    for s, w, r in targets:
        n = tokens.get(s, 0)
        blocks = -(-n // block)
        slots = 0
        if (s, w, r) in live:
            # the last block is short; a whole pass is n tokens
            passes, rest = divmod(size * w / whole, n)
            slots = min(int(passes) * blocks + round(rest / block), r * blocks)
        plans.append(Plan(s, w, r, n, blocks, slots))
    return plans


def draw_shards(plans: list[Plan], seed: int, shard_slots: int = SHARD_SLOTS, max_shards: int = MAX_SHARDS) -> list[tuple[int, str, int, int]]:
    """(shard, source, first slot of the source, slots): a multinomial draw per shard from what the sources
    have left, so that the shards' counts vary and add up to the planned ones."""
    left = np.array([p.slots for p in plans], np.int64)
    total = int(left.sum())
    if not total:
        return []
    per = max(shard_slots, math.ceil(total / max_shards))
    rng = np.random.default_rng(seed)
    given = np.zeros(len(plans), np.int64)
    out = []
    for shard in range(math.ceil(total / per)):
        size = min(per, int(left.sum()))
        counts = np.minimum(rng.multinomial(size, left / left.sum()), left)
        while (short := size - int(counts.sum())) > 0:
            spare = left - counts
            counts += np.minimum(rng.multinomial(short, spare / spare.sum()), spare)
        out += [(shard, plans[i].source, int(given[i]), int(c)) for i, c in enumerate(counts) if c]
        given += counts
        left -= counts
    return out


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a pseudorandom permutation of 0..n-1, chosen by ``key``, takes ``index``: a four-round Feistel
    network over the next even power of two, walked until it is back within n."""
    index, n, key = (np.asarray(x).astype(np.uint64) for x in (index, n, key))
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        low, high, h, k = out[todo] & mask[todo], out[todo] >> half[todo], mask[todo], key[todo]
        for r in range(4):
            mixed = (low + k + np.uint64(r * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            low, high = (high ^ (mixed >> np.uint64(32))) & h, low
        out[todo] = high << half[todo] | low
        todo = out >= n
    return out.astype(np.int64)


def _key(seed: int, source: str, turn: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}|{source}|{turn}".encode(), digest_size=8).digest(), "big")


def token_offsets(docs: DataFrame, chunks: int) -> DataFrame:
    """``docs`` (doc_id, source, ids) with n, its tokens, and start, those of its source before it.

    Running counts are made within ``chunks`` parts per source, by the hash of doc_id, and over the parts'
    totals; so no source, however large, is one task.
    """
    sized = docs.withColumn("n", F.size("ids").cast("bigint")).where("n > 0").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    parts = sized.groupBy("source", "chunk").agg(F.sum("n").alias("part"))
    before = parts.select("source", "chunk", (F.sum("part").over(Window.partitionBy("source").orderBy("chunk")) - F.col("part")).alias("base"))
    within = F.sum("n").over(Window.partitionBy("source", "chunk").orderBy("doc_id", F.xxhash64("ids")).rowsBetween(Window.unboundedPreceding, 0))
    return (
        sized.withColumn("within", within - F.col("n"))
        .join(before, ["source", "chunk"])  # chunks rows per source
        .withColumn("start", F.col("base") + F.col("within"))
        .drop("within", "base", "chunk")
    )


def blocks_of(docs: DataFrame, block: int = BLOCK_TOKENS) -> DataFrame:
    """(source, block, doc_ids, ids): every source's tokens in blocks of ``block``, the last one shorter."""
    pieces = (
        docs.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n") - 1) / block))))
        .withColumn("at", F.greatest(F.col("start"), F.col("block") * block))
        .withColumn("to", F.least(F.col("start") + F.col("n"), (F.col("block") + 1) * block))
        .select("source", "block", "at", "doc_id", F.slice("ids", (F.col("at") - F.col("start") + 1).cast("int"), (F.col("to") - F.col("at")).cast("int")).alias("part"))
    )
    held = F.array_sort(F.collect_list(F.struct("at", "doc_id", "part")))  # at most `block` tokens
    return (
        pieces.groupBy("source", "block")
        .agg(held.alias("p"))
        .select("source", "block", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.part").alias("ids"))
    )


def mix(docs: DataFrame, targets: DataFrame, seed: int = 7, block: int = BLOCK_TOKENS, total: int | None = None, chunks: int | None = None, vocabulary: str = VOCABULARY) -> tuple[DataFrame, list[Plan]]:
    """(mixture, plan). The mixture has shard, slot, source, block, turn (which use of the block), doc_ids,
    n_tokens and ids, a row per slot.

    ``docs`` has doc_id, source and text, ``targets`` source, target_share and max_repeats (one row per
    source; of repeated rows the first by its values counts, rows with a null are left out). Documents
    without tokens (null, empty) or of a source without target give nothing; a target whose source has
    no tokens gets no slots. No block, and so no record, is used more than max_repeats times, and before
    a block is used again all of its source are. Without documents or targets the mixture is empty.
    """
    spark = docs.sparkSession
    wanted = (
        targets.select(F.col("source").cast("string"), F.col("target_share").cast("double").alias("w"), F.col("max_repeats").cast("int").alias("r"))
        .where("source is not null and w is not null and r is not null")
        .groupBy("source")
        .agg(F.min(F.struct("w", "r")).alias("t"))
        .select("source", "t.w", "t.r")
    )
    goals = sorted((x.source, x.w, x.r) for x in wanted.limit(MAX_SOURCES + 1).collect())
    if len(goals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources have a target")
    listed = docs.select("doc_id", "source", "text").where(F.col("source").isin([g[0] for g in goals]) & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    encoded = cut(with_ids(spread(listed), "text", ["doc_id", "source"], vocabulary=vocabulary))
    placed = token_offsets(encoded, chunks or max(8, -(-encoded.count() // CHUNK_DOCS)))
    sizes = {r.source: r.n for r in placed.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # at most MAX_SOURCES rows
    plans = plan_slots(goals, sizes, block, total)
    blocks = {p.source: p.blocks for p in plans}
    rows = [(shard, s, first, n, blocks[s]) for shard, s, first, n in draw_shards(plans, seed)]
    drawn = spark.createDataFrame(rows, "shard int, source string, first bigint, n bigint, blocks bigint")
    slots = drawn.select("shard", "source", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("use")).withColumn(
        "turn", F.floor(F.col("use") / F.col("blocks")).cast("int")
    )

    def place(source: pd.Series, turn: pd.Series, use: pd.Series, blocks: pd.Series) -> pd.Series:
        keys = pd.Series([f"{s}|{t}" for s, t in zip(source, turn, strict=True)], dtype=str)
        code, names = pd.factorize(keys)
        by = np.array([_key(seed, *((n.rpartition("|")[0], int(n.rpartition("|")[2])))) for n in names], np.uint64)
        return pd.Series(permute((use % blocks).to_numpy(), blocks.to_numpy(), by[code] if len(code) else by))

    slots = slots.withColumn("block", F.pandas_udf(place, "bigint")("source", "turn", "use", "blocks"))
    mixture = slots.join(blocks_of(placed, block), ["source", "block"]).select(
        "shard", F.col("use").alias("slot"), "source", "block", "turn", "doc_ids", F.size("ids").alias("n_tokens"), "ids"
    )
    return mixture, plans
