"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. A document's words are streamed
through it; at each word it knows the longest run that ends there and occurs in some item. A
run of `span` words or more means that the last `span` words are a window of an item, and they
are hit; an item shorter than `span` is a window as a whole. Each state knows the items whose
window ends in it, so the items come with the match.

Benchmarks are small beside the corpus but of no fixed size. Spark cuts long items into pieces
that overlap by `span` - 1 words, so that no window is lost, numbers blocks of pieces by running
sums of their words and stores them. A block has fewer than `block_words` words and one piece
more, and an automaton at most two states per word, which bounds what the driver and a task hold:
one block at a time is read and sent. With several blocks the documents are stored under row
numbers, each block has a pass over them that stores the matches of the documents it hits, and
these are joined by row number at the end.

Words: A-Z in lower case, then runs of ASCII letters and digits and of anything beyond ASCII.
Nulls and texts without words have no words: such documents come out with zeros, such items
are no windows. Repeated documents are judged one by one; repeated items count by item_id,
null ids under the empty string. Empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..params import cut_lineage, work_dir
from .arrow import set_aside, to_columns, with_columns

LANES = 256  # tasks that number the pieces of the items

#: A-Z to lower case, other ASCII that is no letter or digit to a space, the rest as it is.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class Automaton:
    """Transitions, suffix links and longest lengths of all runs of words of some items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], span: int):
        self.span = span
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        runs = []
        for item, words in items:
            last, run = 0, [self.ids.setdefault(w, len(self.ids)) for w in words]
            for c in run:
                last = self._extend(last, c)
            runs.append((item, run))
        #: Per state, the windows that are its only or one of its strings: {length: items}.
        self.windows: dict[int, dict[int, set[str]]] = {}
        for item, run in runs:
            size = min(span, len(run))
            state = length = 0
            for c in run:
                state, length = self.next[state][c], length + 1
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                    length = self.length[state]
                if length >= size:
                    self.windows.setdefault(state, {}).setdefault(size, set()).add(item)
        self.shortest = min((min(span, len(run)) for _, run in runs), default=span)
        #: The nearest state up the links, itself included, that has a window.
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.near = [-1] * len(order)
        for s in order:
            self.near[s] = s if s in self.windows else self.near[self.link[s]] if s else -1

    def _copy(self, p: int, q: int, c: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        """The state of the run so far and c; it may be there already from another item."""
        if (q := self.next[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._copy(last, q, c)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._copy(p, q, c)
        return new

    def _windows_at(self, state: int, length: int) -> Iterator[tuple[int, set[str]]]:
        """Windows that end where the longest match is `length` words and ends in `state`."""
        at = self.near[state]
        while at >= 0:
            for size, items in self.windows[at].items():
                if size <= length:
                    yield size, items
            at = self.near[self.link[at]] if at else -1

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words (from, to; in order, apart) that windows cover, and whose items."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        ids = list(map(self.ids.get, words))
        if len(ids) - ids.count(None) < self.shortest:
            return spans, found
        nexts, links, lengths, near, shortest = self.next, self.link, self.length, self.near, self.shortest
        state = length = 0
        for i, c in enumerate(ids):
            if c is None:
                state = length = 0
                continue
            to = nexts[state].get(c)
            if to is None:
                while state and to is None:
                    state = links[state]
                    to = nexts[state].get(c)
                length = lengths[state]
                if to is None:
                    continue
            state, length = to, length + 1
            if length >= shortest and near[state] >= 0:
                longest = 0
                for size, items in self._windows_at(state, length):
                    longest = max(longest, size)
                    found |= items
                if longest:
                    lo = i + 1 - longest
                    while spans and spans[-1][1] >= lo:
                        lo = min(lo, spans.pop()[0])
                    spans.append((lo, i + 1))
        return spans, found


def item_pieces(
    items: DataFrame, span: int, piece_words: int, id: str = "item_id", text: str = "text"
) -> DataFrame:
    """item, words (joined by one space) and n (their number) of every different piece of the
    items. Items of over `piece_words` words are cut where pieces share `span` - 1 words."""

    def one(batch: pa.RecordBatch) -> dict:
        made = {"item": [], "words": [], "n": []}
        for item, t in zip(*(batch.column(i).to_pylist() for i in range(2))):
            words = words_of(t)
            last = max(0, len(words) - span) if len(words) > piece_words else 0
            for at in range(0, last + 1, piece_words - span + 1):
                if piece := words[at : at + piece_words]:
                    made["item"].append(item or "")
                    made["words"].append(b" ".join(piece).decode())
                    made["n"].append(len(piece))
        return made

    rows = items.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    return to_columns(rows, one, "item string, words string, n long").distinct()


def item_blocks(
    items: DataFrame, span: int, block_words: int, id: str = "item_id", text: str = "text"
) -> DataFrame:
    """block (from 0), item and words, stored by block. Pieces are spread over `LANES` by their
    hash; the sums of the lanes and running sums within them number the words."""
    pieces = cut_lineage(item_pieces(items, span, max(2 * span, block_words // 8), id, text), "pieces")
    pieces = pieces.withColumn("lane", F.pmod(F.xxhash64("item", "words"), F.lit(LANES)))
    lanes = pieces.groupBy("lane").agg(F.sum("n").alias("size")).select(
        "lane", (F.sum("size").over(W.orderBy("lane")) - F.col("size")).alias("before")
    )
    here = F.sum("n").over(W.partitionBy("lane").orderBy("item", "words")) - F.col("n")
    numbered = pieces.withColumn("here", here).join(F.broadcast(lanes), "lane").select(
        F.floor((F.col("before") + F.col("here")) / block_words).cast("int").alias("block"), "item", "words"
    )
    path = work_dir(items.sparkSession, "item-blocks")
    numbered.repartition("block").write.partitionBy("block").parquet(path)
    return items.sparkSession.read.schema("item string, words string, block int").parquet(path)


def matched(docs: DataFrame, items: Broadcast, span: int, text: str = "text") -> DataFrame:
    """The documents with `words` (their number), `spans` and `items` for one block of items,
    sent as (item, words joined by one space)."""
    ready: dict[int, Automaton] = {}

    def one(batch: pa.RecordBatch) -> dict:
        if not ready:
            ready[0] = Automaton([(item, words.encode().split(b" ")) for item, words in items.value], span)
        counts, spans, found = [], [], []
        for t in batch.column(batch.schema.get_field_index(text)):
            words = words_of(t.as_py())
            hit, of = ready[0].match(words)
            counts.append(len(words))
            spans.append([{"lo": lo, "hi": hi} for lo, hi in hit])
            found.append(sorted(of))
        return {"words": counts, "spans": spans, "items": found}

    return with_columns(docs, one, "words long, spans array<struct<lo:long,hi:long>>, items array<string>")


def _merged(spans):
    """Sorted spans of several blocks, joined where they touch."""
    start = F.slice(spans, 1, 1)
    return F.aggregate(
        F.slice(spans, 2, F.size(spans)), start,
        lambda done, s: F.when(
            F.element_at(done, -1)["hi"] >= s["lo"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["lo"].alias("lo"), F.greatest(F.element_at(done, -1)["hi"], s["hi"]).alias("hi"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, span: int = 10, block_words: int = 200_000, text: str = "text"
) -> DataFrame:
    """The documents with `words`, `spans` (word numbers, ends exclusive) and `items`."""
    spark = docs.sparkSession
    blocks = item_blocks(benchmark, span, block_words)
    last = blocks.agg(F.max("block")).first()[0] or 0

    def sent(block: int) -> Broadcast:
        rows = blocks.filter(F.col("block") == block).select("item", "words").collect()
        return spark.sparkContext.broadcast([tuple(r) for r in rows])

    if not last:
        return matched(docs, sent(0), span, text)
    held, names = set_aside(docs)
    held = cut_lineage(held.withColumn("row", F.monotonically_increasing_id()), "documents")
    hits = work_dir(spark, "hits")
    for block in range(last + 1):
        items = sent(block)
        found = matched(held.select("row", names[text]), items, span, names[text])
        if block:
            found = found.filter(F.size("spans") > 0)
        found.drop(names[text]).write.mode("append").parquet(hits)
        items.destroy()
    found = spark.read.schema("row long, words long, spans array<struct<lo:long,hi:long>>, items array<string>").parquet(hits)
    found = found.groupBy("row").agg(
        F.max("words").alias("words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).withColumn("spans", F.when(F.size("spans") > 0, _merged(F.col("spans"))).otherwise(F.col("spans")))
    kept = [c for c in docs.columns if c not in ("words", "spans", "items")]
    return held.join(found, "row").select(*[F.col(names[c]).alias(c) for c in kept], "words", "spans", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = contaminated_spans(docs.select("doc_id", "text"), benchmark, span)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["hi"] - s["lo"])
    return found.select(
        "doc_id", F.col("words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _cut(text: str, spans: list) -> str:
    """The text without the words of the spans and the ASCII characters between them."""
    raw = text.encode()
    folded = raw.translate(FOLD)
    places, at = [], 0
    for word in folded.split():
        at = folded.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for s in spans:
        out.append(raw[last : places[s["lo"]][0]])
        last = places[s["hi"] - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, span: int = 10, most_covered: float = 0.5
) -> DataFrame:
    """The documents without the spans that windows cover. A document that is covered to more
    than `most_covered` of its words goes as a whole. `n_chars`, if there, is counted anew."""
    held, names = set_aside(docs)
    text = names["text"]
    found = contaminated_spans(held, benchmark, span, text=text)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["hi"] - s["lo"])
    kept = found.filter((n_hit == 0) | (n_hit <= most_covered * F.col("words")))

    def one(batch: pa.RecordBatch) -> dict:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        spans = batch.column(batch.schema.get_field_index("spans")).to_pylist()
        return {"cut": [_cut(t, s) if s else t for t, s in zip(texts, spans)]}

    done = with_columns(kept.drop("items", "words"), one, "cut string", (text, "spans"))
    fields = {"text": F.col("cut"), "n_chars": F.when(F.col("cut").isNotNull(), F.char_length("cut"))}
    return done.select(*[
        (fields[c].cast(docs.schema[c].dataType) if c in fields else F.col(held)).alias(c)
        for c, held in names.items()
    ])
