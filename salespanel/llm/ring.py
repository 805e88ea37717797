"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` places on a ring of 2^31 positions. A row starts at the first
virtual node at or after the hash of its key. A shard takes rows up to its capacity; what
overflows walks on clockwise, one virtual node a round, to the first shard with room. The
capacities are the row count shared out with a rest of at most one, so shard sizes differ by
at most one row (law `rows`), and most rows stay where the plain ring puts them.

Rows of one arc are interchangeable but for their rank, so the walk needs counts per arc
only: shards x vnodes numbers, whatever the table holds. They are the only thing that comes
to the driver. Rows are ranked by a hash of the whole row inside (arc, part), `part` being a
range of this hash, so that an arc with one hot key is ranked by many tasks; offsets of the
parts make the ranks of the arc, which are the order of the hashes whatever the settings of the
session. Built-in functions only.

Nulls: a row with a null key is placed by the hash of its other columns. Repeated rows each
get a slot of their own. An empty table gives an empty result. Columns of the input that are
called `law`, `shard` or `slot` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import cut_lineage

RING_BITS, CELL_BITS = 31, 8
PART_BITS = 6  # parts of an arc, as many on any cluster


def ring(shards: int, vnodes: int, seed: int = 0) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise. A shard's places depend on its own
    number only, so a ring with one more shard has all places of the smaller one."""
    places = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.md5(f"{seed}/{shard}/{v}".encode()).digest()
            places.append((int.from_bytes(digest[:8], "big") >> (64 - RING_BITS), shard))
    return sorted(places)


def _arc(position: Column, places: Sequence[tuple[int, int]]) -> Column:
    """Index of the first virtual node at or after a position. The ring is cut into 256 equal
    cells, so that a row is compared with the few virtual nodes of its own cell."""
    shift = RING_BITS - CELL_BITS
    cells: list[list[int]] = [[] for _ in range(1 << CELL_BITS)]
    for p, _ in places:
        cells[p >> shift].append(p)
    before, bases = 0, []
    for cell in cells:
        bases.append(before)
        before += len(cell)
    inner = "array(" + ", ".join(f"cast(array({', '.join(map(str, c))}) as array<bigint>)" for c in cells) + ")"
    cell = (F.shiftright(position, shift) + 1).cast("int")
    passed = F.size(F.filter(F.element_at(F.expr(inner), cell), lambda p: p < position))
    index = F.element_at(F.expr(f"array({', '.join(map(str, bases))})"), cell) + passed
    return F.when(index == len(places), F.lit(0)).otherwise(index).cast("int")


def walk(counts: Sequence[int], owners: Sequence[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc end up: (arc, first rank, end rank, shard, first slot).

    One round moves every run of still homeless rows one virtual node on. A shard serves the
    runs that stand at its nodes in ring order; a run that fits in part is split.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    out = []
    waiting = [(a, a, 0, n) for a, n in enumerate(counts) if n]
    while waiting:
        homeless = []
        for at, arc, lo, hi in sorted(waiting):
            shard = owners[at]
            take = min(room[shard] - filled[shard], hi - lo)
            if take:
                out.append((arc, lo, lo + take, shard, filled[shard]))
                filled[shard] += take
            if lo + take < hi:
                homeless.append(((at + 1) % len(owners), arc, lo + take, hi))
        waiting = homeless
    return out


def place_on_ring(rows: DataFrame, key: str, shards: int = 8, vnodes: int = 64, seed: int = 0) -> DataFrame:
    """The rows with `law`, `shard` (0 to shards - 1) and `slot` (gapless from 0 in a shard)."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in ("law", "shard", "slot")]
    places = ring(shards, vnodes, seed)
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    at = F.xxhash64(F.lit(seed), F.col(f"`{key}`"))
    at = F.when(F.col(f"`{key}`").isNull(), whole).otherwise(at)
    dealt = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        _arc(F.shiftrightunsigned(at, 64 - RING_BITS), places).alias("arc"),
        F.shiftright(whole, 64 - PART_BITS).cast("int").alias("part"),
        whole.alias("hash"),
    )
    counts = cut_lineage(dealt.groupBy("arc", "part").agg(F.count("*").alias("n")), "ring-counts")
    by_arc = {r["arc"]: r["n"] for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    runs = walk([by_arc.get(a, 0) for a in range(len(places))], [s for _, s in places], shards)
    values = ", ".join(str(run) for run in runs) or "(-1, 0, 0, 0, 0)"
    homes = spark.sql(f"SELECT * FROM VALUES {values} AS t(home_arc, lo, hi, shard, first)")

    offset = F.sum("n").over(
        Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select("arc", "part", F.coalesce(offset, F.lit(0)).alias("offset"))
    within = Window.partitionBy("arc", "part").orderBy("hash")
    ranked = (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["arc", "part"])
        .withColumn("rank", F.col("rank") + F.col("offset"))
    )
    # At most one run of an arc holds a rank. The runs are a few per virtual node.
    found = ranked.join(
        F.broadcast(homes),
        (F.col("arc") == F.col("home_arc")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")),
    )
    return found.select(
        "row.*", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("rank") - F.col("lo")).cast("bigint").alias("slot"),
    )


def sizes_of_texts(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1; a null text has none), text_crc32."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    return place_on_ring(sizes_of_texts(docs), "doc_id", shards).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )
