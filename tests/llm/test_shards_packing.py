import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers

from genespark.llm import packing, sharding, tokens


def test_schedule_is_lpt():
    items = [(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")]
    assert sharding.schedule(items, 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0}


def test_shards(spark, odd, odd_rows, empty):
    got = sharding.assign(odd, 4).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((x[1] or "").encode()) + 1, zlib.crc32((x[1] or "").encode())) for x in odd_rows)
    of_text, slots = defaultdict(set), defaultdict(list)
    for r in got:
        of_text[r.size, r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(empty, 4).count() == 0


def test_shards_equal_the_heap(spark):
    texts = ["x" * (k * 37 % 211) for k in range(150)] + ["y" * 50] * 9
    got = sharding.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5).collect()
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.size
    import hashlib

    sizes = defaultdict(int)
    for t in texts:
        sizes[hashlib.md5(t.encode()).hexdigest()] += len(t) + 1
    want = sharding.schedule([(n, k) for k, n in sizes.items()], 5)
    assert all(r.shard == want[hashlib.md5(texts[r.doc_id].encode()).hexdigest()] for r in got)
    assert max(loads.values()) - min(loads.values()) < 220


def test_mixture_serves_the_earliest_due():
    rng = np.random.default_rng(0)
    for weights in (None, [0.1, 3.0, 1.0, 1.0]):
        totals = np.array([3, 4000, 900, 2500])
        mix = packing.Mixture(totals, weights)
        n = np.arange(0, mix.size + 300, 61)
        served = mix.served(n)
        due = sorted(((i + 0.5) / mix.weights[q], q) for q in range(4) for i in range(totals[q]))
        order = np.array([q for _, q in due])
        for k in rng.choice(len(n), 20):
            assert served[k].tolist() == np.bincount(order[: n[k]], minlength=4).tolist()


def check_pieces(got, rows):
    encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((encoder.ids(r[1] or "").tobytes() + tokens.id_bytes(1) for r in rows), key=lambda x: (len(x), x))
    # Every id lies in one piece; sequences have no gaps and all but the last are full.
    total = sum(len(x) // 4 for x in want)
    filled = defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and r.length > 0
        filled[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in got) == total
    for k in range(len(filled)):
        place = 0
        for offset, length in sorted(filled[k]):
            assert offset == place
            place += length
        assert place == (2048 if k < len(filled) - 1 else total - 2048 * (len(filled) - 1))
    docs = defaultdict(list)
    for r in got:
        docs[r.doc_id, r.doc_tokens, r.queue].append((r.start, bytes(r.ids)))
    if len({(r[0]) for r in rows}) == len(rows):
        joined = []
        for (_, n, _), parts in docs.items():
            parts.sort()
            assert [p for p, _ in parts] == [sum(len(x) // 4 for _, x in parts[:k]) for k in range(len(parts))]
            joined.append(b"".join(x for _, x in parts))
            assert len(joined[-1]) == 4 * n
        assert sorted(joined, key=lambda x: (len(x), x)) == want


def test_pieces(spark, odd, odd_rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    check_pieces(packing.pack(odd, path, 1).collect(), odd_rows)
    rows = [(k, *r[1:]) for k, r in enumerate(odd_rows)]
    check_pieces(packing.pack(spark.createDataFrame(rows, odd.schema).repartition(4), path, 1).collect(), rows)
    assert packing.pack(empty, path, 1).count() == 0


def test_windows_hold_the_mixture_and_sequences_assemble(spark):
    rows = [(k, "alpha beta gamma delta " * (20 + k % 7), "ab"[k % 3 == 0]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1).cache()
    got = pieces.collect()
    total, by_window = sum(r.length for r in got), defaultdict(lambda: defaultdict(int))
    queue = defaultdict(int)
    for r in got:
        by_window[r.sequence_id * 2048 // packing.WINDOW][r.queue] += r.length
        queue[r.queue] += r.length
    for shares in list(by_window.values())[:-1]:
        for q, n in shares.items():
            assert abs(n - packing.WINDOW * queue[q] / total) <= 3
    built = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    assert all(len(r.ids) == 2048 for k, r in built.items() if k < len(built) - 1)
    parts = sorted((r.offset, bytes(r.ids)) for r in got if r.sequence_id == 0)
    assert np.array(built[0].ids).astype("<u4").tobytes() == b"".join(x for _, x in parts)


def test_mixture_of_many_queues(monkeypatch):
    monkeypatch.setattr(packing, "CELLS", 4000)
    rng = np.random.default_rng(4)
    totals = rng.integers(1, 40, 600)
    totals[5] = 9000
    for weights in (None, rng.random(600) + 0.1):
        mix = packing.Mixture(totals, weights)
        due = sorted(((i + 0.5) / mix.weights[q], q) for q in range(600) for i in range(totals[q]))
        order = np.array([q for _, q in due])
        n = np.arange(0, mix.size + 300, 997)
        for k, got in zip(n, mix.served(n), strict=True):
            assert (got == np.bincount(order[:k], minlength=600)).all()


def test_every_source_is_a_queue_beyond_256(spark):
    rows = [(k, "a b c " * (200 if k < 30 else 3), "big" if k < 30 else f"s{k}") for k in range(330)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    for weights in (None, {s: 50.0 if s == "big" else 1.0 for _, _, s in rows}):
        pieces = packing.pack(docs, path, 1, weights).collect()
        assert {r.queue for r in pieces} == {s for _, _, s in rows}
        check_pieces(pieces, [(k, t, None, s) for k, t, s in rows])
