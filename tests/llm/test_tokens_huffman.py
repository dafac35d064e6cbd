import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from genespark.llm import huffman, storage, tokens

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_the_tokenizer(name):
    encoder, rng = tokens.Encoder(public_tokenizers.path(name)), random.Random(3)
    letters = "aB1 \n\t'_.,$é×ªµßÆ\x01\x7f\x80-sStll\x1c Σ"
    texts = ["", " ", "  a  b ", "it's we'll 'S I'M 12 3a4", "<|endoftext|> a", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(800))]
    for _ in range(2):  # the second time from the cache
        assert encoder.encode(texts) == [encoder.ids(t).tobytes() for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_as_the_plain_library_reads_them(name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    plain, encoder = Tokenizer.from_file(path), tokens.Encoder(path)
    contents = [t.content for t in plain.get_added_tokens_decoder().values()]
    texts = [f(c) for c in contents for f in (str, str.upper, "a {} b".format, "x{0}{0}y z".format, "é {}".format, lambda c: c[:-1] + " " + c[-1:])] + ["plain text", "a <| b |> c"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert contents and [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def kraft(lengths):
    return sum(2.0 ** -int(n) for n in lengths if n)


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(1)
    for n in (2, 3, 17, 300):
        counts = rng.integers(1, 1000, n)
        heap = [(int(c), [k]) for k, c in enumerate(counts)]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            cost += a + b
            heapq.heappush(heap, (a + b, x + y))
        assert int((huffman.code_lengths(counts, 24) * counts).sum()) == cost
    skewed = np.array([2**k for k in range(30)])
    limited = huffman.code_lengths(skewed, 6)
    assert limited.max() <= 6 and kraft(limited) <= 1
    assert huffman.code_lengths(np.array([0, 5, 0]), 16).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


def test_pack_and_unpack():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, 1000)
    book = huffman.Codebook(huffman.code_lengths(counts, 16))
    used = np.flatnonzero(counts)
    for n in (1, 127, 128, 129, 5000):
        ids = rng.choice(used, n).astype(np.uint32)
        payload, marks = book.pack(ids)
        assert (book.unpack(payload, marks, n) == ids).all()


def check(spark, docs, rows):
    folder, path = storage.scratch(spark, "t"), public_tokenizers.path("word_bpe_49k.json")
    huffman.write_ids(docs, folder, path, 1)
    got = huffman.read_ids(spark, folder, with_ids=True).collect()
    encoder = tokens.Encoder(path)
    want = sorted(((r[0], encoder.ids(r[1] or "").tobytes() + tokens.id_bytes(1)) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((d is not None, d or 0, len(x) // 4, zlib.crc32(x)) for d, x in want)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [d for d, _ in want]
    place = 0
    for r in got:
        assert r.start == place and len(r.ids) == r.n_tokens
        place += r.n_tokens


def test_files_round_trip(spark, odd, odd_rows):
    check(spark, odd, odd_rows)


def test_empty_table(spark, empty):
    check(spark, empty, [])


def test_document_over_several_blocks(spark):
    text = "word another thing " * 60000
    check(spark, spark.createDataFrame([(1, text), (0, "a")], "doc_id long, text string"), [(1, text), (0, "a")])


def test_one_id_with_most_rows_goes_over_several_files(spark):
    rows = [(None, "same text")] * 900 + [(7, "same text")] * 900 + [(7, f"text {k % 5}") for k in range(200)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    folder = storage.scratch(spark, "t")
    made = huffman.write_ids(spark.createDataFrame(rows[:900], "doc_id long, text string").repartition(4), folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    assert len(made["files"]) > 1 and sum(f["n_docs"] for f in made["files"]) == 900


def test_any_stretch_from_its_checkpoint(spark):
    rows = [(k, "word another thing " * (70000 if k == 3 else 40 * k)) for k in range(40)] + [(None, "")]
    folder = storage.scratch(spark, "t")
    made = huffman.write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    assert len(made["files"]) > 1
    whole = np.concatenate([np.array(r.ids) for r in sorted(huffman.read_ids(spark, folder, with_ids=True).collect(), key=lambda r: r.start)])
    stream = huffman.Stream(folder)
    assert stream.size == len(whole) > huffman.BLOCK
    edges = {0, 1, 127, 128, 129, huffman.BLOCK - 1, huffman.BLOCK, len(whole) - 1, len(whole), *(f["start"] for f in made["files"])}
    spots = sorted(edges | set(np.random.default_rng(4).integers(0, len(whole), 30).tolist()))
    for start in spots:
        for n in (0, 1, 128, 300, 200000):
            assert (stream.read(start, n) == whole[start : start + n]).all() and len(stream.read(start, n)) == len(whole[start : start + n])
