import gzip
import hashlib
import io

import pytest

from genespark.llm import chat, storage, warc


def test_archives_round_trip(spark):
    rows = [(3, "http://a/x y\nz", "same"), (1, None, "same"), (2, "u", None), (5, "u", ""), (None, "u", "same"), (7, "u", "é" * 100000), (8, "u", "other"), (1, None, "same")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    folder = storage.scratch(spark, "w")
    warc.write(pages, folder)
    for split in (64, 1000, 1 << 20):
        got = warc.read(spark, folder, split).collect()
        assert len(got) == len(rows)
        by = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in got)
        assert by == [(False, 1, "response", None), (False, 1, "revisit", 1), (False, 2, "response", None), (False, 3, "revisit", 1), (False, 5, "revisit", 2), (False, 7, "response", None), (False, 8, "response", None), (True, 0, "revisit", 1)]
        for r in got:
            html = next((x[2] or "").encode() for x in rows if x[0] == r.page_id)
            assert r.payload_bytes == len(html)
    least = storage.scratch(spark, "w")
    warc.write(pages, least, least=5)
    assert sum(r.record_type == "revisit" for r in warc.read(spark, least).collect()) == 0
    empty = storage.scratch(spark, "w")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_ranges_own_records_and_reject_false_magic():
    inner = warc.record(1, "u", b"inner", "A" * 32, 5, None) * 3
    records = [warc.record(k, "u", inner + bytes([k]) * 50, "A" * 32, 9, None) for k in range(20)]
    data = b"".join(records)
    starts = [sum(map(len, records[:k])) for k in range(20)]
    for split in (50, 333, 4000):
        found = [r for at in range(0, len(data), split) for r in warc.read_range(io.BytesIO(data), at, min(at + split, len(data)), len(data))]
        assert [r.start for r in found] == starts
    assert gzip.decompress(data).count(b"WARC/1.1") >= 20


def test_damage_is_an_error_wherever_it_is():
    import random

    rng = random.Random(3)
    records = [warc.record(k, "u", rng.randbytes(150), "A" * 32, 9, None) for k in range(40)]
    data = b"".join(records)
    starts = [sum(map(len, records[:k])) for k in range(40)]
    everything = lambda d, split: [r for at in range(0, len(d), split) for r in warc.read_range(io.BytesIO(d), at, min(at + split, len(d)), len(d))]
    for split in (700, 2000, len(data)):
        assert [r.start for r in everything(data, split)] == starts
        for at in range(0, len(data), split):
            # A byte of the first record's magic, and one inside the last record that the range owns.
            own = [s for s in starts if at <= s < at + split]
            for place in (own[0], own[-1] + 60) if own else ():
                broken = bytearray(data)
                broken[place] ^= 0xFF
                with pytest.raises(warc.Broken):
                    everything(bytes(broken), split)


def test_foreign_archives(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    data = warc.member([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "http://x")], block) + warc.member([("WARC-Type", "metadata")], b"x")
    (tmp_path / "x.warc.gz").write_bytes(data)
    (r,) = warc.read(spark, f"file://{tmp_path}").collect()
    assert (r.page_id, r.url, r.payload_bytes, r.record_type, bytes(r.payload)) == (None, "http://x", 5, "response", b"hello")
    assert r.payload_digest == __import__("base64").b32encode(hashlib.sha1(b"hello").digest()).decode()


def test_many_equal_pages(spark):
    rows = [(4, "b", "same")] * 3000 + [(4, "a", "same")] * 2 + [(9, "c", "same"), (None, "n", "only"), (None, "n", "only")]
    folder = storage.scratch(spark, "w")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), folder)
    got = warc.read(spark, folder, 1 << 14).collect()
    assert len(got) == len(rows) and [(r.page_id, r.url) for r in got if r.record_type == "response" and r.page_id] == [(4, "a")]
    assert all(r.refers_to == 4 for r in got if r.record_type == "revisit") and sum(r.record_type == "response" for r in got) == 3


class Rewriting:
    """Tags only the last turn, so each new turn changes what stood before."""

    lookback = None

    def render(self, turns):
        return "".join(f"[{r}|{t}]" + ("<last>" if k == len(turns) - 1 else "") for k, (r, t) in enumerate(turns))

    def escape(self, text):
        return text

    unescape = escape

    def role(self, head):
        return head[1:-1]


def test_spans_and_rewritten_history():
    template = chat.Marked()
    for lookback in (1, None):
        template.lookback = lookback
        turns = [("user", "a </turn> ### x"), ("assistant", "b\\"), ("user", ""), ("assistant", "###")]
        (segment,) = chat.render_conversation(template, iter(turns), frozenset({"assistant"}))
        assert segment["text"] == template.render(turns) and segment["rewritten"] == []
        assert [template.unescape(segment["text"][a:b]) for _, _, a, b, _ in segment["turns"]] == [t for _, t in turns]
    (segment,) = chat.render_conversation(Rewriting(), iter([("u", "1"), ("a", "2"), ("u", "3")]), frozenset())
    assert segment["rewritten"] == [1, 2]


def test_rewritten_history_is_written_as_rendered(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import the test

    class Shared(Rewriting):
        def render(self, turns):
            return super().render(turns).replace("[", "[[")

    rows = [(1, 0, "u", "same"), (1, 1, "a", "same"), (1, 2, "a", "sentinel"), (2, 0, "u", "one")]
    folder = storage.scratch(spark, "c")
    chat.write(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), folder, Rewriting(), ("a",))
    got = {r.conv_id: r for r in chat.read(spark, folder, Rewriting()).collect()}
    turns = [(r, t) for c, _, r, t in rows if c == 1]
    assert got[1].formatted_chars == len(Rewriting().render(turns)) and got[1].n_rewritten == 2 and got[2].n_rewritten == 0
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"samesentinel").hexdigest()
    (segment,) = chat.render_conversation(Shared(), iter(turns), frozenset({"a"}))
    assert segment["text"] == Shared().render(turns) and [segment["text"][a:b] for _, _, a, b, _ in segment["turns"]] == [t for _, t in turns]


def test_long_conversations_in_segments(monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 200)
    monkeypatch.setattr(chat, "WHOLE", 5)
    turns = [(("user", "assistant")[k % 2], f"turn {k} sentinel") for k in range(40)]
    for lookback in (1, 3, None):
        template = chat.Marked()
        template.lookback = lookback
        parts = list(chat.render_conversation(template, iter(turns), frozenset({"assistant"})))
        assert "".join(p["text"] for p in parts) == template.render(turns) and len(parts) > 3
        assert [template.unescape(p["text"][a:b]) for p in parts for _, _, a, b, _ in p["turns"]] == [t for _, t in turns]


def test_escape_is_reversible_and_marks_are_unique():
    import itertools

    template = chat.Marked()
    for parts in itertools.product(["\\", "### ", "###", "</turn>", "a", "\n", ":"], repeat=3):
        text = "".join(parts)
        assert template.unescape(template.escape(text)) == text
        assert template.role(f"### {template.escape(text).replace(':', chr(92) + ':')}: ") == text


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 64)
    probe = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", probe), (1, 1, "assistant", None), (None, 0, None, "x"), (2, 5, "a:b", "long " * 100), (2, 1, "assistant", "é\n"), (2, 1, "assistant", "é\n")]
    frame = spark.createDataFrame([(*r, "n") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    folder = storage.scratch(spark, "c")
    chat.write(frame, folder)
    got = {r.conv_id: r for r in chat.read(spark, folder).collect()}
    for conv_id in (1, 2, None):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv_id), key=lambda x: x)
        r = got[conv_id]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(chat.Marked().render([t[1:] for t in turns]))
    empty = storage.scratch(spark, "c")
    chat.write(frame.limit(0), empty)
    assert chat.read(spark, empty).count() == 0


def test_a_false_lookback_is_found():
    class Counting(chat.Marked):
        def render(self, turns):
            head = "many\n" if len(turns) > 2 else ""
            return head + super().render(turns)

    turns = [("user", f"t{k}") for k in range(5)]
    assert len(list(chat.render_conversation(chat.Marked(), iter(turns), frozenset()))) == 1
    for n in (3, 4, 5):
        with pytest.raises(ValueError, match="looks back"):
            list(chat.render_conversation(Counting(), iter(turns[:n]), frozenset()))
