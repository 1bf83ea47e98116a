"""Near duplicates: banded MinHash, odd sketches, and a check of whole shingle sets.

Documents of equal shingle sets are one node. Bands of MinHash samples put similar
nodes into common buckets; the number of bands follows from the share of similar
pairs that may be missed. An odd sketch folds the samples of a node into a parity
bitmap: the exclusive or of two bitmaps has at most two ones per sample in which the
nodes differ, so its count bounds their similarity. A second one folds the shingles
themselves, and its count is never above the number of shingles that only one of two
nodes has. Pairs beyond either bound are not looked at; what is left, little more than
the true links, is compared on the full sets.

A bucket does not give all its pairs. Members that have too few shingles in common with
all other candidates together are out. Then each member meets the bucket's centre, first
the one that shares most buckets with others, then ones drawn by a hash. Only members
that are then still in different components are held against one another, inside the
join, by their sketches; pairs that cannot be links never leave it. Sets travel for the
pairs that pass.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import exchange
from shelfmark.llm.components import components
from shelfmark.llm.parts import PartTable, binary, spans, text_bytes, texts_of, tidy
from shelfmark.llm.quality import LOWER
from shelfmark.llm.words import keys, mix, sums, word_spans
from shelfmark.sources.staging import hand_out, scope, stage

ROWS = 4
# Rounds of stars with centres drawn anew before what is left is compared in full.
CENTRES = 2
SKETCH_BITS = 512
# Bits of the sketch of the shingles themselves.
SET_BITS = 1024
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles of ``n`` words, A-Z lower-cased.

    Fewer words are one shingle; a text without words has none.
    """
    out: list[np.ndarray] = []
    for i, j in spans(texts, 1 << 20):
        data, offsets = text_bytes(texts.slice(i, j - i))
        starts, ends, at = word_spans(data, offsets)
        word, _ = keys(LOWER[data], starts, ends)
        rolled = word.copy()
        for k in range(1, n):
            rolled[:-k] = mix(rolled[:-k] * MULTIPLIER + word[k:]) if len(word) > k else rolled[:-k]
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= n:
                out.append(np.unique(rolled[a:b - n + 1]))
            elif b > a:
                out.append(np.frombuffer(hashlib.blake2b(word[a:b].tobytes(), digest_size=8).digest(), "<u8"))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def bands_for(similarity: float, misses: float) -> int:
    """Bands of ROWS samples such that at most this share of pairs of this similarity meets in none."""
    return math.ceil(math.log(misses) / math.log(1 - min(similarity, 0.99) ** ROWS))


def samples(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash samples (rows: the sets, none of them empty)."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    random = np.random.default_rng(20140)
    out = np.empty((len(sets), count), np.uint32)
    for i in range(count):
        a, b, c = random.integers(0, 1 << 32, 3, np.uint32)
        v = flat * (a | np.uint32(1)) + b
        v ^= v >> np.uint32(15)
        v *= c | np.uint32(1)
        v ^= v >> np.uint32(13)
        out[:, i] = np.minimum.reduceat(v, starts)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    wide = found.astype(np.uint64).reshape(len(found), -1, ROWS)
    out = np.arange(wide.shape[1], dtype=np.uint64)[None, :] * MULTIPLIER
    for k in range(ROWS):
        out = mix(out * MULTIPLIER + wide[:, :, k])
    return out.view(np.int64)


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """Per row, the parity of the number of samples hashed to each bit, as 64-bit words."""
    place = np.arange(found.shape[1], dtype=np.uint64) << np.uint64(32)
    bit = (mix(found.astype(np.uint64) + place) % np.uint64(SKETCH_BITS)).astype(np.int64)
    at = (np.arange(len(found)) * SKETCH_BITS)[:, None] + bit
    odd = np.bincount(at.ravel(), minlength=len(found) * SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(found), SKETCH_BITS), axis=1).view(np.int64)


def set_sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles at each of SET_BITS places, as 64-bit words."""
    place = (hashes >> np.uint64(64 - SET_BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(place, minlength=SET_BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def sketch_limit(similarity: float, count: int) -> int:
    """Ones in the exclusive or that a pair of this similarity stays within, six deviations allowed."""
    differing = count * (1 - similarity) + 6 * math.sqrt(count * similarity * (1 - similarity))
    return 2 * math.ceil(differing)


def _differ(a: Column, b: Column, bits: int) -> Column:
    ones = [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(bits // 64)]
    total = ones[0]
    for one in ones[1:]:
        total = total + one
    return total


def _signatures(shingle: int, bands: int):
    count = bands * ROWS

    def sign(part: pa.Table) -> pa.Table:
        texts = texts_of(part.column("text"))
        sets = shingle_sets(texts, shingle)
        some = [i for i, s in enumerate(sets) if len(s)]
        keyed: list = [None] * len(sets)
        key_rows, sketch_rows = [], []
        for at in range(0, len(some), 256):
            group = some[at:at + 256]
            found = samples([sets[i] for i in group], count)
            key_rows.append(band_keys(found))
            sketch_rows.append(odd_sketches(found))
            for i in group:
                keyed[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
        has = np.array([k is not None for k in keyed], bool)
        return pa.table({
            "row": part.column("row"), "doc_id": part.column("doc_id"),
            "n": pa.array([len(s) for s in sets], pa.int64()), "set_key": binary(keyed),
            "bands": _lists(key_rows, has, bands), "sketch": _lists(sketch_rows, has, SKETCH_BITS // 64),
            "odd": _lists([set_sketch(sets[i])[None, :] for i in some], has, SET_BITS // 64)})

    return sign


def _lists(rows: list[np.ndarray], has: np.ndarray, width: int) -> pa.Array:
    offsets = np.append(0, np.cumsum(has * width)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows).ravel() if rows else np.zeros(0, np.int64)))


def _sets_of(part: pa.Table, wanted: np.ndarray, shingle: int) -> tuple[pa.Table, list[np.ndarray]]:
    part = part.filter(pa.array(np.isin(part.column("row").to_numpy(), wanted)))
    return part, shingle_sets(texts_of(part.column("text")), shingle)


def _send_shingles(shingle: int, owners: int):
    """A part's question: which shingles of its candidates do other candidates have?"""

    def send(part: pa.Table, wanted: pa.Table) -> pa.Table:
        own = part.column("part")[0].as_py() if part.num_rows else 0
        _, sets = _sets_of(part, wanted.column("row").to_numpy(), shingle)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        distinct, counts = np.unique(flat, return_counts=True)
        return exchange.messages(own, distinct, counts > 1, owners, 64)

    return send


def _possible(shingle: int, owners: int, percent: int):
    """The sets of those candidates that share enough shingles with all others together."""

    def pick(part: pa.Table, answers: pa.Table) -> pa.Table:
        wanted = answers.column("row").drop_null().to_numpy()
        part, sets = _sets_of(part, wanted, shingle)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        distinct, back = np.unique(flat, return_inverse=True)
        told = answers.filter(answers.column("owner").is_valid())
        shared = exchange.marked(distinct, told, owners, 64)[back]
        sizes = np.array([len(x) for x in sets], np.int64)
        keep = 100 * sums(shared.astype(np.int64), np.append(0, np.cumsum(sizes))) >= percent * sizes
        return pa.table({"node": part.column("row").filter(pa.array(keep)),
                         "hashes": binary([x.tobytes() for x, k in zip(sets, keep, strict=True) if k])})

    return pick


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = np.zeros(len(x), bool)
            for i, (p, q) in enumerate(zip(x, y, strict=True)):
                p, q = np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8")
                if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                    both = np.sort(np.concatenate([p, q]), kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    keep[i] = 100 * common >= percent * (len(both) - common)
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep))

    return run


class NearDuplicates:
    """The classes of a table of texts; ``table`` must have the columns doc_id and text."""

    def __init__(self, table: PartTable, shingle: int = 5, percent: int = 80, misses: float = 1e-8):
        self.table, self.shingle, self.percent = table, shingle, percent
        self.bands = bands_for(percent / 100, misses)
        self.limit = sketch_limit(percent / 100, self.bands * ROWS)

    def _candidates(self, nodes: DataFrame) -> DataFrame:
        """The full sets (node, hashes) of the nodes that may have a link at all.

        A linked node has at least ``percent`` of its shingles in common with one other
        candidate. One that has fewer in common with all of them together is out, which
        is asked by an exchange of shingle hashes.
        """
        with scope():
            wanted = stage(nodes.select(F.col("node").alias("row"), F.shiftright("node", 33).cast("int").alias("part")), "wanted")
            owners = max(1, wanted.count() // 4096)
            asked = self.table.each_with(["text"], wanted, _send_shingles(self.shingle, owners), exchange.MESSAGE)
            marks = stage(asked.groupBy("owner").applyInArrow(tidy(exchange.judge), exchange.ANSWER), "marks")
            told = marks.withColumn("row", F.lit(None).cast("long")).unionByName(
                wanted.withColumns({"owner": F.lit(None).cast("int"), "marks": F.lit(None).cast("binary")}))
            return stage(self.table.each_with(
                ["text"], told, _possible(self.shingle, owners, self.percent), "node long, hashes binary"), "sets", level=-3)

    def _near(self, a: str, b: str) -> Column:
        """Whether the marks (n, sketch, odd) of two nodes leave room for a link; it does for all linked pairs but the missed ones."""
        def of(side: str, field: str) -> Column:
            return F.col(f"{side}.{field}")

        small, large = F.least(of(a, "n"), of(b, "n")), F.greatest(of(a, "n"), of(b, "n"))
        # Of two linked sets at most (100 - percent) / (100 + percent) of both sizes together are in one only.
        apart = _differ(of(a, "odd"), of(b, "odd"), SET_BITS)
        return (
            (100 * small >= self.percent * large)
            & ((100 + self.percent) * apart <= (100 - self.percent) * (of(a, "n") + of(b, "n")))
            & (_differ(of(a, "sketch"), of(b, "sketch"), SKETCH_BITS) <= self.limit))

    def _links(self, pairs: DataFrame, marks: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) whose marks leave room for a link and whose full sets are similar enough."""
        mark = F.struct("n", "sketch", "odd")
        with scope():
            near = stage(
                pairs.join(marks.select(F.col("node").alias("a"), mark.alias("p")), "a")
                .join(marks.select(F.col("node").alias("b"), mark.alias("q")), "b")
                .where(self._near("p", "q")).select("a", "b"), "near")
            both = (
                near.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b"))
            return hand_out(both.select("a", "b", "x", "y").mapInArrow(
                tidy(_similar(self.percent)), "a long, b long"), "confirmed")

    @staticmethod
    def _stars(members: DataFrame, order: Column) -> DataFrame:
        """Each member with the centre of its bucket, where they are in different components."""
        centre = F.struct(F.col("node").alias("centre"), F.col("component").alias("there"))
        with scope():
            centres = stage(members.groupBy("key").agg(F.max_by(centre, order).alias("c")).select("key", "c.*"), "centres")
            return hand_out(members.join(centres, "key").where("component <> there").select(
                F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "pairs")

    @staticmethod
    def _open(members: DataFrame, links: DataFrame) -> DataFrame:
        """The members of buckets that lie in several components, with their components."""
        with scope():
            found = components(links)
            placed = stage(members.drop("component").join(found, "node", "left").select(
                "key", "node", F.coalesce("component", "node").alias("component")), "placed")
            several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
            return hand_out(placed.join(stage(several.select("key"), "open"), "key"), "members")

    def _rest(self, members: DataFrame, marks: DataFrame) -> DataFrame:
        """The pairs of members of one bucket that are in different components and may be links by their marks."""
        with scope():
            marked = stage(members.join(marks, "node"), "marked")
            apart = (F.col("p.node") < F.col("q.node")) & (F.col("p.component") != F.col("q.component"))
            return hand_out(
                marked.alias("p").join(marked.alias("q"), F.col("p.key") == F.col("q.key")).where(apart & self._near("p", "q"))
                .select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct(), "rest")

    def _members(self, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Buckets of several candidates (key, node, component: the node itself), and the candidates' sets."""
        with scope():
            keyed = nodes.select("node", F.explode("bands").alias("key"))
            shared = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "buckets")
            members = stage(keyed.join(shared, "key"), "members")
            sets = self._candidates(members.select("node").distinct())
            return hand_out(members.join(sets.select("node"), "node").withColumn("component", F.col("node")), "members"), sets

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """Signatures (row, doc_id, n, set_key, ...) and, per set_key, component_id and keep_row.

        component_id is the smallest doc_id of all rows that links lead to, keep_row
        the key of the row that has it (the smallest key of several).
        """
        id_type = self.table.kind("doc_id")
        signed = stage(self.table.each(
            ["doc_id", "text"], _signatures(self.shingle, self.bands),
            f"row long, doc_id {id_type}, n long, set_key binary, bands array<bigint>, sketch array<bigint>, odd array<bigint>"), "signed")
        some = signed.where(F.col("set_key").isNotNull())
        # Rows of one set have the same bands and sketches; a task sends one row per set.
        nodes = stage(some.groupBy("set_key").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best"),
            *[F.first(c).alias(c) for c in ("n", "bands", "sketch", "odd")])
            .select(F.col("best.row").alias("node"), "best", "set_key", "n", "bands", "sketch", "odd"), "nodes")
        marks = nodes.select("node", "n", "sketch", "odd")
        members, sets = self._members(nodes)
        # First the member with the most company over all its buckets, the likely original of many copies.
        with scope():
            sizes = stage(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "sizes")
            company = stage(members.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("company")), "company")
            pairs = self._stars(members.join(company, "node"), F.struct("company", -F.col("node")))
            links = hand_out(self._links(pairs, marks, sets), "links")
        members = self._open(members, links)
        # Then, where a bucket is still in pieces, other centres: each bucket has its own, so a member meets many.
        for turn in range(CENTRES):
            pairs = self._stars(members, F.struct(F.xxhash64("key", "node", F.lit(turn)), -F.col("node")))
            links = stage(links.unionByName(self._links(pairs, marks, sets)), "links")
            members = self._open(members, links)
        rest = self._rest(members, marks)
        found = components(links.unionByName(self._links(rest, marks, sets)))
        by_node = nodes.select("node", "best", "set_key").join(found, "node", "left").select(
            "set_key", "best", F.coalesce("component", "node").alias("component"))
        by_node = stage(by_node, "placed")
        best = stage(by_node.groupBy("component").agg(F.min("best").alias("first")), "first")
        return signed, stage(by_node.join(best, "component").select(
            "set_key", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("keep_row")), "classes")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, misses: float = 1e-8, doc_id: str = "doc_id", texts: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Rows are linked when their sets of ``shingle``-word shingles share at least
    ``percent`` of 100; ``misses`` bounds the share of pairs just that similar that are
    not found. Null, empty and wordless texts have no shingle and no link; texts of any
    length are whole. Equal sets are always linked. A row without doc_id names a
    component only if all its rows are such. An empty table gives an empty result.
    """
    with scope():
        table = PartTable(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{texts}`").alias("text")), "near")
        signed, classes = NearDuplicates(table, shingle, percent, misses).classes()
        return hand_out(signed.select("row", "doc_id", "n", "set_key").join(classes, "set_key", "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, misses: float = 1e-8) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) that stay, whole: of each class the one of the smallest doc_id."""
    with scope():
        table = PartTable(docs, "near")
        with scope():
            signed, classes = NearDuplicates(table, shingle, percent, misses).classes()
            chosen = hand_out(signed.select("row", "set_key").join(classes, "set_key", "left").where(
                F.col("keep_row").isNull() | (F.col("keep_row") == F.col("row"))).select("row"), "kept")
        return hand_out(table.keep(chosen), "deduplicated", "zstd")
