"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection, classes.

Two shingle sets can link only when their sizes lie within the threshold of each other, and when few
enough shingles differ. Each set is put into its size band (and into the next one, if a partner may lie
there). In a band, shingles are dealt by hash into one part more than may differ, plus a few; sets that
link agree on at least one part, so the tile of a band, a part and that part's content brings every
linking pair together, while sets that only share a passage rarely agree on a whole part.

Members of a tile are first held against one of them, the hub. Only where classes remain apart in a tile
are other pairs compared, since pairs of one class add nothing. A tile is put in order of class and size
and cut into blocks of bounded bytes; blocks of different classes meet pairwise, first with bitmaps only:
bits that one side has and the other lacks stand for at least as many shingles that are not shared, which
bounds the overlap from above. Sets with a possible partner then meet again with their sorted arrays,
which are intersected exactly.

All links are counted from the classes: sets that link are in one class, so the blocks of a class, in order
of size, meet pairwise and each pair of sets is compared once.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.session import keep as hold
from marketlens.session import tidy

from .common import arrow_map, buckets_for, freed, mix, pieces, private, table, text_bytes, word_codes

_A = np.uint64(0x9E3779B97F4A7C15)
#: Texts, or pairs of bitmaps, and pairs of sets, that are Python objects at a time.
TEXTS, PAIRS = 500, 100


def shingle_sets(texts: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its word ``width``-grams; of the whole, when there are
    fewer words; none without words."""
    for a, z in pieces(texts):
        h, _, counts = word_codes(texts[a:z])
        with np.errstate(over="ignore"):
            code = h[: max(0, len(h) - width + 1)].copy()
            for j in range(1, width):
                code = code * _A + h[j : j + len(code)]
            code = mix(code + np.uint64(width))
            first = 0
            for n in counts.tolist():
                if n >= width:
                    yield np.unique(code[first : first + n - width + 1])
                elif n:
                    whole = np.uint64(0)
                    for x in h[first : first + n]:
                        whole = whole * _A + x
                    yield mix(np.array([whole + np.uint64(n)]))
                else:
                    yield np.zeros(0, np.uint64)
                first += n


def shingles(text: bytes | None, width: int) -> np.ndarray:
    return next(shingle_sets([text], width))


class Bands:
    """Size bands for a threshold of ``num / den``; a band's upper end is half as much again as its lower."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, self.edges[-1] * 3 // 2))
        self.parts: dict[int, tuple[int, int]] = {}

    def of(self, size: int) -> list[int]:
        """The set's own band, and the next one if a linking set may lie in it."""
        own = int(np.searchsorted(self.edges, size, "right")) - 1
        more = [j for j in range(own + 1, len(self.edges)) if size * self.den >= self.num * self.edges[j]] if size * self.den >= self.num * self.edges[own + 1] else []
        return [b for b in [own, *more] if self._differ(b)]

    def _differ(self, band: int) -> int:
        """How many shingles can differ in a linking pair of the band; none: only equal sets link."""
        return (self.den - self.num) * 2 * (self.edges[band + 1] - 1) // (self.den + self.num)

    def split(self, band: int) -> tuple[int, int]:
        """Number of parts, and how many of them may be empty in a set without its empty parts mattering."""
        if band not in self.parts:
            differ, least, slack = self._differ(band), self.edges[band] * self.num / self.den, 0
            for _ in range(20):
                parts = differ + 1 + slack
                empty = parts * (1 - 1 / parts) ** least
                slack = math.ceil(empty + 3 * math.sqrt(empty)) if empty > 0.05 else 0
            self.parts[band] = (differ + 1 + slack, slack)
        return self.parts[band]

    def keys(self, found: np.ndarray) -> np.ndarray:
        """Tile keys of a set. Sets that link share one: parts that agree are more than ``slack``, so one
        of them is not empty, or both sets have more empty parts and give keys for these too."""
        out = []
        for band in self.of(len(found)):
            parts, slack = self.split(band)
            part = ((found >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            with np.errstate(over="ignore"):
                salt = mix(np.uint64([band + 1])) + part[first] * _A
                out.append(mix(np.add.reduceat(found, first) + salt))
                if parts - len(first) > slack:
                    empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part[first])
                    out.append(mix(mix(np.uint64([band + 1])) + empty * _A))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def links(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)


def bitmap(found: np.ndarray) -> bytes:
    """One bit for each shingle in 4 to 8 times as many places."""
    places = 1 << max(6, (4 * len(found) - 1).bit_length())
    bits = np.zeros(places, np.uint8)
    bits[(found & np.uint64(places - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def most_shared(a: bytes, b: bytes, a_size: int, b_size: int) -> int:
    """Upper bound of the shingles in common. The longer bitmap is folded to the shorter one's length."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x, y = np.bitwise_or.reduce(x.reshape(-1, n)), np.bitwise_or.reduce(y.reshape(-1, n))
    return min(a_size - int(np.bitwise_count(x & ~y).sum()), b_size - int(np.bitwise_count(y & ~x).sum()))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, s1, s2): set size and 128-bit digest of each row's set."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            sizes, digests = [], []
            for found in shingle_sets(b["text"], width):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            flat = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield {"doc_id": b["doc_id"], "text_key": b["text_key"], "n_shingles": sizes, "s1": flat[:, 0], "s2": flat[:, 1]}

    return arrow_map(docs, run, "doc_id long, text_key long, n_shingles long, s1 long, s2 long", rows=TEXTS)


def _keys(docs: DataFrame, width: int, bands: Bands) -> DataFrame:
    """(key, doc_id); of equal sets in one partition only the first gives keys."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        seen: set[bytes] = set()
        for b in batches:
            keys, ids, held = [], [], 0
            for doc_id, found in zip(b["doc_id"], shingle_sets(b["text"], width)):
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                if doc_id is None or digest in seen:
                    continue
                seen.add(digest)
                keys.append(bands.keys(found))
                ids.append(np.full(len(keys[-1]), doc_id, np.int64))
                held += len(ids[-1])
                if held > 200_000:
                    yield {"key": np.concatenate(keys).view(np.int64), "doc_id": np.concatenate(ids)}
                    keys, ids, held = [], [], 0
            if held:
                yield {"key": np.concatenate(keys).view(np.int64), "doc_id": np.concatenate(ids)}

    return arrow_map(docs, run, "key long, doc_id long", rows=TEXTS)


def keep(df: DataFrame) -> DataFrame:
    """Hold a result that several jobs read, and free what led to the ones before: some forty small tables are
    made on the way to the links."""
    kept = hold(df)
    tidy(df.sparkSession)
    return kept


def _tiles(keys: DataFrame, partitions: int, block: int) -> DataFrame:
    """(tile, block, hub, members): documents with a key in common, at most ``block`` in a row. Keys are
    read in order, so a tile of any size takes no more memory than a block."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        tile, hub, number, members = None, None, 0, []
        out: dict = {"tile": [], "block": [], "hub": [], "members": []}

        def close(last: bool) -> None:
            nonlocal number, members
            if number or len(members) > 1:
                for c, v in zip(out, (tile, number, hub, members)):
                    out[c].append(v)
            number, members = (0, []) if last else (number + 1, [])

        for b in batches:
            key, doc = np.asarray(b["key"], np.int64), np.asarray(b["doc_id"], np.int64)
            if not len(key):
                continue
            # Keys that occur once and cannot go on in a neighbouring batch are passed over at once.
            same = key[1:] == key[:-1]
            wanted = np.concatenate([same, [True]]) | np.concatenate([[True], same])
            for k, d in zip(key[wanted].tolist(), doc[wanted].tolist()):
                if k != tile:
                    if tile is not None and members:
                        close(True)
                    tile, hub, number, members = k, d, 0, [d]
                elif not members or members[-1] != d:
                    if len(members) == block:
                        close(False)
                    members.append(d)
            if len(out["tile"]) >= 5000:
                yield out
                out = {c: [] for c in out}
        if tile is not None and members:
            close(True)
        yield out

    ordered = keys.repartition(partitions, "key").sortWithinPartitions("key", "doc_id")
    return arrow_map(ordered, run, "tile long, block long, hub long, members array<long>")


FILTER_BITS = 1 << 25


def _filter(ids: DataFrame):
    """Broadcast of a bitmap of 4 MB, whatever the number of ids: the ids modulo its length. It spares most
    texts the way to a join, which still decides; full, it would spare none."""
    at = ids.select((F.pmod("rep", F.lit(FILTER_BITS)) + 1).alias("at"))  # the functions count from 1
    rows = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    packed = bytearray(FILTER_BITS // 8)
    for r in rows:  # 4096 bytes each
        packed[(r.part - 1) * 4096 : r.part * 4096] = r.bits
    return ids.sparkSession.sparkContext.broadcast(bytes(packed))


def _passes(packed: bytes, doc_id: int) -> bool:
    at = doc_id % FILTER_BITS
    return packed[at >> 3] >> (at & 7) & 1 == 1


class _Verifier:
    """Compares pairs of representatives: sizes and bitmaps, then the sets of those that are left. Sets are
    made anew from the texts for the few that are wanted, rather than stored for all."""

    def __init__(self, raw: DataFrame, reps: DataFrame, wanted: DataFrame, width: int, bands: Bands):
        self.raw, self.reps, self.width, self.bands = raw, reps, width, bands
        self.bits = keep(self._made(wanted, "bits", bitmap))

    def shingles(self, wanted: DataFrame) -> DataFrame:
        """(rep, n, shingles) of the wanted."""
        return keep(self._made(wanted, "shingles", np.ndarray.tobytes))

    def _made(self, wanted: DataFrame, name: str, made) -> DataFrame:
        filter_, width = _filter(wanted), self.width

        def run(batches: Iterator[dict]) -> Iterator[dict]:
            seen: set = set()  # a repeated row comes once from each partition
            for b in batches:
                mine = [i for i, d in enumerate(b["doc_id"]) if d is not None and _passes(filter_.value, d)]
                mine = [i for i in mine if (row := (b["doc_id"][i], hash(b["text"][i]))) not in seen and not seen.add(row)]
                out, held = {c: [] for c in ("rep", "s1", "s2", "n", name)}, 0
                for i, found in zip(mine, shingle_sets([b["text"][i] for i in mine], width)):
                    s1, s2 = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64).tolist()
                    for c, v in zip(out, (b["doc_id"][i], s1, s2, len(found), made(found))):
                        out[c].append(v)
                    held += len(found)
                    if held > 1_000_000:
                        yield out
                        out, held = {c: [] for c in out}, 0
                if out["rep"]:
                    yield out

        rows = arrow_map(self.raw, run, f"rep long, s1 long, s2 long, n long, {name} binary", rows=TEXTS)
        # The digest tells a representative from other rows under its id. The few that pass the filter
        # unwanted meet nothing later, and a row that is there twice only repeats a link.
        return rows.join(self.reps, ["rep", "s1", "s2"], "left_semi").drop("s2")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that link."""
        bands = self.bands
        side = lambda df, name, value: df.select(F.col("rep").alias(name), F.col("n").alias(f"{name}_n"), F.col(value).alias(f"{name}_x"))

        def bound(batches: Iterator[dict]) -> Iterator[dict]:
            for x in batches:
                ok = [bands.links(most_shared(p, q, m, n), m, n) for p, q, m, n in zip(x["a_x"], x["b_x"], x["a_n"], x["b_n"])]
                yield {c: list(itertools.compress(x[c], ok)) for c in ("a", "b")}

        def exact(batches: Iterator[dict]) -> Iterator[dict]:
            for x in batches:
                ok = [bands.links(shared(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)), m, n) for p, q, m, n in zip(x["a_x"], x["b_x"], x["a_n"], x["b_n"])]
                yield {c: list(itertools.compress(x[c], ok)) for c in ("a", "b")}

        near = (F.col("a_n") * bands.den >= F.col("b_n") * bands.num) & (F.col("b_n") * bands.den >= F.col("a_n") * bands.num)
        likely = pairs.join(side(self.bits, "a", "bits"), "a").join(side(self.bits, "b", "bits"), "b").where(near)
        likely = keep(arrow_map(likely, bound, "a long, b long", rows=TEXTS))
        sets = self.shingles(likely.select(F.col("a").alias("rep")).union(likely.select("b")).distinct())
        return arrow_map(likely.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b"), exact, "a long, b long", rows=PAIRS)


def classes(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (a, b) can reach. Each round takes the
    neighbours' smallest label and then the label's label; it ends when nothing changes."""
    edges = keep(links.select("a", "b").union(links.select("b", "a")).toDF("node", "next").distinct())
    at = keep(edges.groupBy("node").agg(F.least(F.col("node"), F.min("next")).alias("label")))
    while True:
        near = edges.join(at.select(F.col("node").alias("next"), "label"), "next").groupBy("node").agg(F.min("label").alias("best"))
        new = at.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "best").alias("label"))
        jump = at.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = keep(new.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")))
        changed = new.where("old <> label").limit(1).count()
        at = new.select("node", "label")
        if not changed:
            return at


def jaccard_classes(docs: DataFrame, *, width: int = 4, num: int = 85, den: int = 100, block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, text_key), one per row of ``docs``; ids are whole numbers,
    ``text_key`` is a hash of the text.

    Words are runs of other than ASCII white space, A-Z lower-cased; two sets link when their
    intersection is at least ``num / den`` of their union. ``component_id`` is the smallest id reachable
    over links. Null and empty texts, and texts of blanks, have no shingles and are alone. Rows without
    an id link nothing and have no component. Equal sets are one node, so copies cost no pairs. Rows with
    the same id but different texts are different documents that share an id. Other columns are ignored.
    """
    named, labels, _ = _joined(docs, width, Bands(num, den), block, id_col, text_col)
    out = named.join(labels, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id"), "text_key")


def jaccard_links(docs: DataFrame, *, width: int = 4, num: int = 85, den: int = 100, block: int = 256, id_col: str = "doc_id", text_col: str = "text", shingles_per_block: int = 500_000) -> DataFrame:
    """The rows of ``jaccard_classes`` with ``n_links``: with how many other documents each one links, copies
    counted each. Repeated rows are one document; texts under one id do not link to each other. Rows
    without shingles or id have 0.
    """
    bands = Bands(num, den)
    named, labels, verify = _joined(docs, width, bands, block, id_col, text_col)
    copies = keep(named.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("rep", "s1", "n_shingles").agg(F.count_distinct("doc_id").alias("copies")))
    members = labels.select(F.col("label").alias("tile"), F.col("node").alias("rep")).join(copies.withColumnRenamed("n_shingles", "n"), "rep")
    order = Window.partitionBy("tile").orderBy("n", "rep", "s1")  # narrow rows
    members = keep(members.withColumn("block", F.floor(F.sum("n").over(order) / shingles_per_block)))
    blocks = members.groupBy("tile", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("sets"))
    left, right = (blocks.select("tile", *(F.col(c).alias(f"{c}{k}") for c in blocks.columns[1:])) for k in (1, 2))
    pairs = left.join(right, "tile").where(f"(block1 < block2 OR block1 = block2 AND sets1 > 1) AND most1 * {den} >= least2 * {num}")
    sides = pairs.select("tile", "block1", "block2", F.explode(F.array_distinct(F.array("block1", "block2"))).alias("block"))
    sets = verify.shingles(members.select("rep").distinct()).select("rep", "s1", "shingles")
    shipped = sides.join(members, ["tile", "block"]).join(sets, ["rep", "s1"])

    def count(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("n", "ascending"), ("rep", "ascending"), ("s1", "ascending")])
        reps, half, copies_, blocks_ = (rows[c].to_numpy() for c in ("rep", "s1", "copies", "block"))
        first = np.concatenate([[True], (reps[1:] != reps[:-1]) | (half[1:] != half[:-1])])  # repeated rows
        reps, half, copies_, blocks_ = reps[first], half[first], copies_[first], blocks_[first]
        found = [np.frombuffer(x, np.uint64) for x in rows["shingles"].filter(pa.array(first)).to_pylist()]
        n = count_links(found, reps, blocks_, rows["block1"][0].as_py() != rows["block2"][0].as_py(), copies_, bands)
        some = n > 0
        return pa.table({"rep": reps[some], "s1": half[some], "links": n[some]})

    counted = shipped.groupBy("tile", "block1", "block2").applyInArrow(freed(count), "rep long, s1 long, links long")
    counted = counted.groupBy("rep", "s1").agg(F.sum("links").alias("links"))
    known = keep(copies.drop("n_shingles").join(counted, ["rep", "s1"], "left").select("rep", "s1", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = named.join(known, ["rep", "s1"], "left").join(labels, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "text_key")


def count_links(sets: list[np.ndarray], reps: np.ndarray, blocks: np.ndarray, across: bool, copies: np.ndarray, bands: Bands) -> np.ndarray:
    """For each of the sets, in order of size, the copies of those it links with; ``across``: only of the
    other block. The intersections of a set with all larger ones are sums of its marks at their places."""
    sizes = np.array([len(x) for x in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    words, place = np.unique(np.concatenate(sets), return_inverse=True)
    mark, out = np.zeros(len(words), bool), np.zeros(len(sets), np.int64)
    last = np.searchsorted(sizes * bands.num, sizes * bands.den, "right")  # larger sets that may link
    for i in range(len(sets) - 1):
        a = max(i + 1, int(np.searchsorted(blocks, blocks[i], "right"))) if across else i + 1
        z = int(last[i])
        if a >= z:
            continue
        own = place[starts[i] : starts[i + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[place[starts[a] : starts[z]]], starts[a:z] - starts[a], dtype=np.int64)
        mark[own] = False
        link = (bands.den * both >= bands.num * (sizes[i] + sizes[a:z] - both)) & (reps[a:z] != reps[i])
        out[i] += copies[a:z][link].sum()
        out[a:z] += np.where(link, copies[i], 0)
    return out


def _joined(docs: DataFrame, width: int, bands: Bands, block: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, _Verifier]:
    """(doc_id, text_key, n_shingles, rep, s1) of each row; (node, label) of the representatives that link."""
    docs = private(docs, doc_id=id_col, text=text_col)
    own_id = F.col("doc_id").cast("long").alias("doc_id")
    raw = docs.select(own_id, F.col("text").cast("binary").alias("text"))
    spark = docs.sparkSession
    sets = keep(_sets(docs.select(own_id, F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text")), width))
    reps = keep(sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")))
    named = keep(sets.join(reps, ["s1", "s2"], "left").select("doc_id", "text_key", "n_shingles", "s1", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")))
    ids = keep(named.where("n_shingles > 0").select("doc_id", "rep").distinct())
    rep_of = lambda doc, rep: ids.select(F.col("doc_id").alias(doc), F.col("rep").alias(rep))

    parts = buckets_for(spark, text_bytes(docs), 16_000_000)
    tiles = keep(_tiles(_keys(raw, width, bands), parts, block))
    stars = tiles.select("hub", F.explode("members").alias("doc")).where("hub <> doc").distinct()
    stars = stars.join(rep_of("hub", "a"), "hub").join(rep_of("doc", "b"), "doc").where("a <> b")
    stars = keep(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    # Tiles of one block and two members are settled by their star.
    wide = tiles.where("size(members) > 2 OR block > 0").select("tile").distinct()
    members = tiles.join(wide, "tile", "left_semi").select("tile", F.explode("members").alias("doc"))
    members = members.join(rep_of("doc", "rep"), "doc").select("tile", "rep").distinct()
    wanted = stars.select(F.col("a").alias("rep")).union(stars.select("b")).distinct()

    verify = _Verifier(raw, reps, wanted, width, bands)
    links = keep(verify.links(stars))
    labels = classes(links)
    more = keep(_between(members, labels, verify))
    if more.limit(1).count():  # links between classes: classes of classes
        class_of = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"{name}_class"))
        between = more.join(class_of("a"), "a", "left").join(class_of("b"), "b", "left")
        between = between.select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b")).where("a <> b")
        joined = classes(between).withColumnRenamed("label", "least")
        known = labels.join(joined.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("least", "label").alias("label"))
        new = joined.join(labels, "node", "left_anti").select("node", F.col("least").alias("label"))
        labels = known.unionByName(new)
    return named, labels, verify


def _between(members: DataFrame, labels: DataFrame, verify: _Verifier) -> DataFrame:
    """Links (a, b) between different classes of one tile: enough of them to join what links."""
    bands = verify.bands
    classed = members.join(labels.withColumnRenamed("label", "class"), F.col("rep") == F.col("node"), "left")
    classed = keep(classed.select("tile", "rep", F.coalesce("class", "rep").alias("class")))
    # Tiles in which classes remain apart; of tiles with the same members, one.
    alike = ("count", "first", "last", "mixed")
    open_ = classed.groupBy("tile").agg(
        F.min("class").alias("low"), F.max("class").alias("high"),
        F.count("*").alias("count"), F.min("rep").alias("first"), F.max("rep").alias("last"), F.bit_xor(F.xxhash64("rep")).alias("mixed"),
    ).where("low <> high").groupBy(*alike).agg(F.min("tile").alias("tile"))
    apart = classed.join(open_, "tile", "left_semi").join(verify.bits.select("rep", "n"), "rep")

    def possible(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("class", "ascending"), ("rep", "ascending")])
        reps, of, sizes = (rows[c].to_numpy() for c in ("rep", "class", "n"))
        found = may_link(of, sizes, [np.frombuffer(x, np.uint8) for x in rows["bits"].to_pylist()], bands)
        return pa.table({"tile": rows["tile"].take(pa.array(np.flatnonzero(found))), "rep": pa.array(reps[found], pa.int64())})

    def compare(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("class", "ascending"), ("rep", "ascending")])
        found = join_classes(rows["rep"].to_pylist(), rows["class"].to_pylist(), [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()], bands)
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    near = _meet(apart, verify.bits, "bits", bands, 8_000_000).applyInArrow(freed(possible), "tile long, rep long").distinct()
    near = keep(apart.join(near, ["tile", "rep"], "left_semi"))
    sets = verify.shingles(near.select("rep").distinct())
    return _meet(near, sets, "shingles", bands, 500_000).applyInArrow(freed(compare), "a long, b long")


def _meet(members: DataFrame, sets: DataFrame, column: str, bands: Bands, shingles_per_block: int):
    """Groups of blocks that may hold linking sets of different classes: the members (tile, rep, class, n)
    of one or two blocks of a tile with their ``column``."""
    num, den = bands.num, bands.den
    order = Window.partitionBy("tile").orderBy("class", "n", "rep")  # narrow rows
    members = members.withColumn("block", F.floor(F.sum("n").over(order) / shingles_per_block))
    blocks = members.groupBy("tile", "block").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
    left, right = (blocks.select("tile", *(F.col(c).alias(f"{c}{k}") for c in blocks.columns[1:])) for k in (1, 2))
    pairs = left.join(right, "tile").where("block1 <= block2 AND NOT (low1 = high1 AND low2 = high2 AND low1 = low2)")
    pairs = pairs.where((F.col("most1") * den >= F.col("least2") * num) & (F.col("most2") * den >= F.col("least1") * num))
    sides = pairs.select("tile", "block1", "block2", F.explode(F.array_distinct(F.array("block1", "block2"))).alias("block"))
    shipped = sides.join(members, ["tile", "block"]).join(sets.select("rep", column), "rep")
    return shipped.groupBy("tile", "block1", "block2")


def may_link(of: np.ndarray, sizes: np.ndarray, maps: list[np.ndarray], bands: Bands) -> np.ndarray:
    """Which sets have, by size and bitmap, a possible partner in another class."""
    places = min(len(x) for x in maps)
    bits = np.stack([np.bitwise_or.reduce(x.reshape(-1, places)) for x in maps]).view(np.uint64)
    found = np.zeros(len(of), bool)
    for i in range(len(of) - 1):
        rest = np.arange(i + 1, len(of))
        rest = rest[(of[rest] != of[i]) & (sizes[rest] * bands.den >= sizes[i] * bands.num) & (sizes[i] * bands.den >= sizes[rest] * bands.num)]
        if len(rest):
            most = _bound(bits, sizes, i, rest)
            ok = rest[bands.den * most >= bands.num * (sizes[i] + sizes[rest] - most)]
            if len(ok):
                found[ok] = found[i] = True
    return found


def _bound(bits: np.ndarray, sizes: np.ndarray, i: int, rest: np.ndarray) -> np.ndarray:
    mine = sizes[i] - np.bitwise_count(bits[i] & ~bits[rest]).sum(axis=1, dtype=np.int64)
    theirs = sizes[rest] - np.bitwise_count(bits[rest] & ~bits[i]).sum(axis=1, dtype=np.int64)
    return np.minimum(mine, theirs)


def join_classes(reps: list[int], classes_: list[int], sets: list[np.ndarray], bands: Bands) -> list[tuple[int, int]]:
    """Links that join classes of the given sets: each set against those of other classes; a class that
    has been joined is not looked at again."""
    sizes = np.array([len(x) for x in sets])
    places = 1 << max(6, min(15, (2 * int(sizes.max()) - 1).bit_length()))
    bits = np.zeros((len(sets), places), np.uint8)
    for i, x in enumerate(sets):
        bits[i, (x & np.uint64(places - 1)).astype(np.int64)] = 1
    bits = np.packbits(bits, axis=1).view(np.uint64)
    of = np.array(classes_, np.int64)
    found = []
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        near = (sizes[rest] * bands.den >= sizes[i] * bands.num) & (sizes[i] * bands.den >= sizes[rest] * bands.num)
        rest = rest[near & (of[rest] != of[i])]
        if not len(rest):
            continue
        most = _bound(bits, sizes, i, rest)
        for j in rest[bands.den * most >= bands.num * (sizes[i] + sizes[rest] - most)].tolist():
            if of[j] != of[i] and bands.links(shared(sets[i], sets[j]), len(sets[i]), len(sets[j])):
                found.append((reps[i], reps[j]))
                of[of == of[j]] = of[i]
    return found


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).drop("text_key")


def op1_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(spark, sf_dir, "documents")).drop("text_key")


_WORDS_SQL = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN r ON d.doc_id = r.x GROUP BY ALL
"""

#: The same with the number of links of each document.
LINKS_ORACLE = ORACLE.replace("AS component_id", "AS component_id, coalesce(k.k, 0) AS n_links").replace(
    "JOIN r ON d.doc_id = r.x", "JOIN r ON d.doc_id = r.x LEFT JOIN (SELECT x, count(*) AS k FROM l GROUP BY x) k ON d.doc_id = k.x"
)
