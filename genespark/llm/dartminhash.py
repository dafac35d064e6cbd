"""Near-duplicate classes by DartMinHash signatures and banded joins.

A document is the weighted set of its five-word shingles (lower case; words are
runs of letters and digits), with weights that grow with the logarithm of their
count.  Hashed darts are thrown into the regions
of its elements: along every element and weight strip they come as a Poisson
process in rank order, drawn from the element's hash alone, so two documents see
the same darts where their regions overlap.  A dart is kept if it falls under the
element's weight; of all kept ones, each coordinate takes the earliest.  Two
coordinates agree with the probability of the weighted Jaccard similarity, and
only about ``k ln k`` darts are drawn for a document, however many elements it has.

Bands of the signature give buckets.  In a bucket every text is compared with the
one that shares most buckets with others, which links copies to their centre
without making all pairs.  Candidates whose signatures are five standard errors
under the threshold are dropped, the rest is decided by the exact weighted Jaccard
similarity of the whole texts.  Texts of a bucket that are then still in different
components may be linked directly, past the centre.  For those buckets a prefix
join finishes the job without loss: shingles are put in one order, rare ones first,
and two texts can only reach the threshold if they share a shingle early enough in
both lists.  Per shingle only texts outside its largest component meet the others.
Components come from label propagation with pointer jumping over staged tables.

Rows and cases: equal texts are one class (null and empty texts too, together);
texts under five words have one shingle of all their words, texts without a word
only match their equals; repeated rows and null ``doc_id`` are rows like others
(a class takes the smallest id that is not null); other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

SHINGLE = 5
THRESHOLD = 0.8
#: 25 bands of 5 coordinates: a pair at 0.8 is missed with probability 5e-5.
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Shingles sketched at once, 30 MB with all their darts.
CHUNK = 1 << 17
#: Counters for the frequency of shingles.
SLOTS = 1 << 18
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of all five-word shingles in order, with repeats."""
    words = WORD.findall((text or "").lower().encode("utf-8"))
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = min(SHINGLE, len(words))
    if not n:
        return hashed
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashed[k : len(words) - n + 1 + k]
    return mix(out)


def weighted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights: 1, 2, 3, ... for 1, 2, 4, ... occurrences and more.

    Damped, so that a line repeated a hundred times doesn't outweigh a whole text.
    """
    element, count = np.unique(shingles(text), return_counts=True)
    return element, np.frexp(count)[1].astype(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - common
    return common / total if total else 0.0


def darts(element: np.ndarray, low: np.ndarray, width: np.ndarray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Darts of weight strips in rank order, up to each row's limit: row, rank, weight, coordinate, name."""
    rows, rank = np.arange(len(element)), np.zeros(len(element))
    seed = mix(element ^ (low.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    step = 0
    while len(rows):
        step += 1
        draw = mix(seed[rows] + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[rows]
        near = rank <= limit[rows]
        rows, rank, draw = rows[near], rank[near], draw[near]
        second = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        weight = low[rows] + width[rows] * ((second >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        yield rows, rank, weight, (mix(second) % np.uint64(COORDINATES)).astype(np.int64), second


def sketch(element: np.ndarray, count: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Signatures (n_docs, COORDINATES) of weighted sets given as rows (element, count, doc).

    Every document needs an element.  The rank limit is chosen so that all
    coordinates are likely hit; documents with a gap get twice the darts.
    """
    out = np.zeros((n_docs, COORDINATES), dtype=np.uint64)
    total = np.bincount(doc, count, n_docs)
    # Weight strips [0, 1), [1, 2), [2, 4), ... up to the count.
    strips = np.ceil(np.log2(count)).astype(np.int64) + 1
    row = np.repeat(np.arange(len(element)), strips)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(nth == 0, 0.0, 2.0 ** (nth - 1))
    width = np.where(nth == 0, 1.0, low)
    todo, n_darts = np.ones(n_docs, dtype=bool), COORDINATES * (np.log(COORDINATES) + 3)
    while todo.any():
        own = np.flatnonzero(todo[doc[row]])
        at = row[own]
        limit = n_darts / total[doc[at]]
        parts = []
        for hit, rank, weight, coordinate, name in darts(element[at], low[own], width[own], limit):
            under = weight < count[at[hit]]
            parts.append((doc[at[hit[under]]] * COORDINATES + coordinate[under], rank[under], name[under]))
        place, rank, name = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((rank, place))
        place, name = place[order], name[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else []
        out.reshape(-1)[place[first]] = name[first]
        hits = np.bincount(place[first] // COORDINATES, minlength=n_docs)
        todo &= hits < COORDINATES
        n_darts *= 2
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each document."""
    out = np.zeros((len(signature), BANDS), dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    parts = signature.reshape(len(signature), BANDS, ROWS)
    for k in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def sketches(texts: list[str | None]) -> tuple[list, list]:
    """Band keys and 16-bit signatures of texts; none where a text has no word."""
    keys, short = [[] for _ in texts], [b"" for _ in texts]

    def flush():
        if held:
            sizes = [len(e) for _, e, _ in held]
            found = sketch(np.concatenate([e for _, e, _ in held]), np.concatenate([c for _, _, c in held]), np.repeat(np.arange(len(held)), sizes), len(held))
            cut = (found & np.uint64(0xFFFF)).astype("<u2")
            for (k, _, _), key, part in zip(held, bands(found).tolist(), cut, strict=True):
                keys[k], short[k] = key, part.tobytes()
        held.clear()

    held, size = [], 0
    for k, text in enumerate(texts):
        element, count = weighted(text)
        if len(element):
            held.append((k, element, count))
            size += len(element) + 2 * COORDINATES
        if size >= CHUNK:
            flush()
            size = 0
    flush()
    return keys, short


def signatures(docs: DataFrame) -> DataFrame:
    """Staged rows: rid (a row number of ours), doc_id, key (of the text), bands, signature."""

    def run(batches):
        for batch in batches:
            keys, short = sketches(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.binary())], ["doc_id", "key", "bands", "signature"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    found = rows.mapInArrow(storage.worker("near_duplicates", run), "doc_id long, key binary, bands array<long>, signature binary")
    return storage.stage(found.select(F.monotonically_increasing_id().alias("rid"), "*"), "signatures")


def text_key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def alike(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures don't rule out the threshold."""
    least = int((threshold - 5 * (threshold * (1 - threshold) / COORDINATES) ** 0.5) * COORDINATES)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype="<u2").reshape(-1, COORDINATES) for k in (2, 3))
            near = (a == b).sum(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    left = nodes.select(F.col("rid").alias("a"), F.col("signature").alias("left"))
    right = nodes.select(F.col("rid").alias("b"), F.col("signature").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(storage.worker("near_duplicates", run), "a long, b long")


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """Staged (rid, text) of the wanted nodes."""
    wanted = wanted.join(nodes.select("rid", "key", F.col("doc_id").alias("own_id")), "rid")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    found = rows.join(wanted, (rows["key"] == wanted["key"]) & rows["doc_id"].eqNullSafe(wanted["own_id"])).select("rid", "text")
    return storage.stage(found.dropDuplicates(["rid"]) if repeated else found, "texts")


def numbered(text: str | None) -> np.ndarray:
    """The weighted set as a plain one: every unit of weight gets a name of its own."""
    element, count = weighted(text)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return mix(np.repeat(element, count) + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def prefixes(texts: DataFrame, threshold: float) -> DataFrame:
    """Staged (rid, token, place, size): the tokens by which a text can meet an equal in the join.

    Tokens are ordered by how many of ``texts`` have them, counted in SLOTS slots
    by hash; any order that is the same for all texts loses nothing.
    """

    def count(batches):
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount((numbered(text) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS) if text and len(text) > SLOTS else 0
            short = [numbered(t) for t in batch.column(0).to_pylist() if t and len(t) <= SLOTS]
            if short:
                total += np.bincount((np.concatenate(short) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    found = texts.select("text").mapInArrow(storage.worker("near_duplicates", count), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS, dtype=np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(counts)  # SLOTS numbers

    def run(batches):
        for batch in batches:
            rids, parts, sizes = [], [], []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                token = numbered(text)
                order = np.lexsort((token, shared.value[(token % np.uint64(SLOTS)).astype(np.int64)]))
                parts.append(token[order[: len(token) - int(np.ceil(threshold * len(token) - 1e-9)) + 1]])
                rids.append(rid)
                sizes.append(len(token))
            n = [len(p) for p in parts]
            place = np.concatenate([np.arange(k) for k in n]) if n else []
            token = np.concatenate(parts).view(np.int64) if n else []
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rids, n), pa.int64()), pa.array(token, pa.int64()), pa.array(place, pa.int64()), pa.array(np.repeat(sizes, n), pa.int64())], ["rid", "token", "place", "size"])

    return texts.select("rid", "text").mapInArrow(storage.worker("near_duplicates", run), "rid long, token long, place long, size long")


def meetings(texts: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different labels that may reach the threshold; none is lost.

    A pair whose first shared token stands at places p and q has at most
    min(size - p, size - q) tokens in common.
    """
    tokens = storage.stage(prefixes(texts, threshold).join(labels, "rid"), "tokens")
    counts = tokens.groupBy("token", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("token").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1").select("token", "main")
    strays = tokens.join(main, "token").filter("label != main").select("token", F.col("rid").alias("x"), F.col("label").alias("x_label"), F.col("place").alias("x_place"), F.col("size").alias("x_size"))
    need = F.ceil(threshold / (1 + threshold) * (F.col("size") + F.col("x_size")) - 1e-6)
    able = F.least(F.col("size") - F.col("place"), F.col("x_size") - F.col("x_place")) >= need
    met = strays.join(tokens, (strays["token"] == tokens["token"]) & (F.col("label") != F.col("x_label")) & able)
    return met.select(F.least("x", "rid").alias("a"), F.greatest("x", "rid").alias("b")).distinct()


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose texts reach the threshold exactly."""

    def run(batches):
        last, known = None, None
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if a != last:
                    last, known = a, weighted(left)
                keep.append(similarity(known, weighted(right)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = texts.select(F.col("rid").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("rid").alias("a"), F.col("text").alias("left"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(storage.worker("near_duplicates", run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Staged (rid, label) of all linked nodes: the smallest rid of its component."""
    both = storage.stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = storage.stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("rid"), F.least("a", "m").alias("label")), "labels")
    while True:
        reach = both.join(labels.select(F.col("rid").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        hooked = labels.join(reach, labels["rid"] == reach["a"]).select("rid", "label", F.least("label", "m").alias("next"))
        far = labels.select(F.col("rid").alias("next"), F.col("label").alias("far"))
        moved = storage.stage(hooked.join(far, "next").select("rid", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("changed")), "labels")
        labels, done = moved.select("rid", "label"), moved.filter("changed").isEmpty()
        if done:
            return labels


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Classes of near-equal texts.

    Returns rows (doc_id, key, class_id, class_size, keeper), one for each input
    row, and texts (key, own_id, keeper), one for each distinct text; ``keeper`` marks
    the text of a class that stays, and ``own_id`` the id of its first row.
    """
    spark = docs.sparkSession
    storage.small_batches(spark)
    rows = signatures(docs)
    groups = rows.groupBy("key").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("least_id"), F.count("*").alias("n"))
    nodes = storage.stage(rows.drop("key").join(groups, "rid"), "nodes")
    repeated = not rows.groupBy("key", "doc_id").count().filter("count > 1").isEmpty()
    buckets = nodes.select("rid", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = storage.stage(buckets.join(sizes, "bucket"), "members")
    degree = members.groupBy("rid").agg(F.sum("n").alias("degree"))
    central = members.join(degree, "rid").groupBy("bucket").agg(F.max_by("rid", F.struct("degree", F.negative("rid"))).alias("lead"))
    star = members.join(central, "bucket").filter("rid != lead").select(F.col("lead").alias("a"), F.col("rid").alias("b")).distinct()
    star = storage.stage(alike(star, nodes, threshold), "star")
    texts = texts_of(docs, nodes, members.select("rid").distinct(), repeated)
    links = storage.stage(verify(star, texts, threshold), "links")
    labels = components(links)
    # The lead of a bucket has met all others of it.
    known = members.join(central, "bucket").filter("rid != lead").join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    mixed = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("bucket")
    open_nodes = storage.stage(known.join(mixed, "bucket", "left_semi").select("rid", "label").distinct(), "open")
    met = meetings(texts.join(open_nodes.select("rid"), "rid"), open_nodes, threshold)
    met = storage.stage(verify(storage.stage(met, "met"), texts, threshold), "links")
    if not met.isEmpty():
        labels = components(links.union(met))
    placed = nodes.select("rid", "key", "doc_id", "least_id", "n").join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    placed = storage.stage(placed, "placed")
    sums = placed.groupBy("label").agg(F.min("least_id").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.coalesce("least_id", F.lit((1 << 63) - 1)), "rid"))["rid"].alias("keeper_rid"))
    found = placed.join(sums, "label").select("key", F.col("least_id").alias("own_id"), "class_id", "class_size", (F.col("rid") == F.col("keeper_rid")).alias("keeper"))
    found = storage.stage(found, "classes")
    return rows.select("doc_id", "key").join(found.drop("own_id"), "key"), found


def keep(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class: that with the smallest id, all columns unchanged, whatever their names."""
    names = docs.columns
    own = []  # names of our own that the table doesn't have
    while len(own) < 3:
        k = len(own)
        own.append(next(n for n in (f"__{k}" + "_" * j for j in range(len(names) + 1)) if n not in names))
    text, key, least = own
    _, texts = classes(docs, threshold)
    stay = texts.filter("keeper").select(F.col("key").alias(key), F.col("own_id").alias(least))
    rows = docs.withColumn(text, text_key())
    found = rows.join(stay, (F.col(text) == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(least)), "left_semi")
    single = found.groupBy(text, "doc_id").count().filter("count > 1").isEmpty()
    return (found if single else found.dropDuplicates([text])).select(*(F.col(f"`{n}`") for n in names))
