"""Chat formatting with turn spans found by incremental black-box rendering.

A template is anything with ``render(turns) -> str``.  Successive prefixes of a
conversation are rendered and consecutive outputs compared: what the longer one
adds is the new turn's span.  A longer output that doesn't begin with the shorter
one means that the template rewrites history; such a turn is marked, and the
spans found before it no longer hold: the conversation's text is then the rendering of
all turns, in which each content is found by a sentinel in its place.  Inside the added
text, too, a turn's content is found by rendering the same prefix with a sentinel.

Whole prefixes are rendered for the first ``WHOLE`` turns.  A template that declares
``lookback`` says on how many earlier turns a turn's rendering depends; further
prefixes are rendered from there on, which keeps a long conversation linear.  The
claim is checked: after 1, 2, 4, 8, ... turns and at the end the whole prefix is
rendered and must be the text so far, else an error is raised.  Without it all
prefixes are whole.

Turns are ordered by ``turn``, then role and text.  A conversation goes through one
task, which holds its turns; with a declared ``lookback`` its text is written in
segments of bounded size as it comes, without one its text is held as well.

Rows and cases: null text is an empty one, a null role is "", null ``conv_id`` is
a conversation of its own, repeated rows are turns of their own, other columns are
ignored, an empty table gives no file and no row.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

#: Characters of formatted text after which a segment of a conversation is written.
SEGMENT = 1 << 20
#: Turns up to which prefixes are rendered whole, whatever the template declares.
WHOLE = 64
SENTINEL = "sentinel"
Turn = tuple[str, str]


class Template(Protocol):
    lookback: int | None

    def render(self, turns: list[Turn]) -> str: ...

    def escape(self, text: str) -> str: ...

    def unescape(self, text: str) -> str: ...


class Marked:
    """``### role: text </turn>`` and a line end; control strings in texts get a backslash."""

    lookback = 1
    control = re.compile(r"\\|### |###\Z|</turn>")

    def escape(self, text: str) -> str:
        return self.control.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def render(self, turns: list[Turn]) -> str:
        return "".join(f"### {self.escape(role).replace(':', chr(92) + ':')}: {self.escape(text)} </turn>\n" for role, text in turns)

    def role(self, head: str) -> str:
        """The role in the text before a turn's content."""
        return self.unescape(head.removeprefix("### ").removesuffix(": "))


def spans(template: Template, before: list[Turn], turn: Turn, shorter: str | None = None) -> dict:
    """Rendering of one more turn: added text, content span in it, whether history was rewritten.

    ``shorter`` may give the rendering of ``before`` if it is known.
    """
    shorter = template.render(before) if shorter is None else shorter
    longer = template.render([*before, turn])
    rewritten = not longer.startswith(shorter)
    added = longer if rewritten else longer[len(shorter) :]
    if rewritten:
        return {"added": added, "begin": None, "end": None, "rewritten": True, "longer": longer}
    probe = template.render([*before, (turn[0], SENTINEL)])
    # The content ends as far from the end as the sentinel does; a role may hold the sentinel as well.
    at = probe.rfind(SENTINEL)
    if at < len(shorter):
        return {"added": added, "begin": None, "end": None, "rewritten": False, "longer": longer}
    begin = at - len(shorter)
    end = len(added) - (len(probe) - at - len(SENTINEL))
    whole = added[begin:end] == template.escape(turn[1])
    return {"added": added, "begin": begin if whole else None, "end": end if whole else None, "rewritten": rewritten, "longer": longer}


def unused(texts: list[str]) -> str:
    """A sentinel that none of the texts holds."""
    sentinel = SENTINEL
    while any(sentinel in t for t in texts):
        sentinel += "x"
    return sentinel


def rewritten_conversation(template: Template, turns: list[Turn], loss_roles: frozenset[str], rewritten: list[int]) -> dict:
    """The one segment of a conversation whose template rewrites history: the rendering of all turns.

    A turn's span goes from the end of the content before it to the end of its own;
    roles are listed, as such a span may hold more than its head.
    """
    text = template.render(turns)
    sentinel, place, marks = unused([text, *(t for _, t in turns)]), 0, []
    for k, (role, content) in enumerate(turns):
        probe = template.render([*turns[:k], (role, sentinel), *turns[k + 1 :]])
        low = probe.find(sentinel)
        high = low + len(template.escape(content))
        whole = low >= 0 and text[low:high] == template.escape(content) and probe.replace(sentinel, template.escape(content), 1) == text
        marks.append([place, high if whole else place, low if whole else None, high if whole else None, role in loss_roles])
        place = high if whole else place
    return {"text": text, "turns": marks, "rewritten": rewritten, "roles": [r for r, _ in turns], "last": True}


def render_conversation(template: Template, turns: Iterator[Turn], loss_roles: frozenset[str]) -> Iterator[dict]:
    """Segments: text, turns as [begin, end, content begin, content end, under loss], rewritten turns, last."""
    before: list[Turn] = []
    shorter: str | None = None
    text, marks, held = [], [], []
    rewritten: list[int] = []
    n = size = 0
    seen: list[Turn] = []
    so_far = hashlib.sha256()

    def check():
        if template.lookback is not None and not rewritten and hashlib.sha256(template.render(seen).encode()).digest() != so_far.digest():
            raise ValueError(f"the template looks back on more turns than {template.lookback}")

    for turn in turns:
        if size >= SEGMENT:
            held.append({"text": "".join(text), "turns": marks, "rewritten": [], "last": False})
            text, marks, size = [], [], 0
            if template.lookback is not None and not rewritten:
                yield from held  # such a template doesn't rewrite, or the check fails
                held = []
        found = spans(template, before, turn, shorter)
        seen.append(turn)
        if found["rewritten"]:
            if template.lookback is not None:
                raise ValueError(f"the template looks back on more turns than {template.lookback}")
            rewritten.append(n)
        begin, end = found["begin"], found["end"]
        marks.append([size, size + len(found["added"]), None if begin is None else size + begin, None if end is None else size + end, turn[0] in loss_roles])
        text.append(found["added"])
        size += len(found["added"])
        so_far.update(found["added"].encode())
        n += 1
        if template.lookback is None or n < WHOLE:
            before, shorter = seen[:], found["longer"]
        else:
            before, shorter = seen[n - template.lookback :], None
        if n & (n - 1) == 0:
            check()
    if n & (n - 1):
        check()
    if rewritten:
        yield rewritten_conversation(template, seen, loss_roles, rewritten)
        return
    yield from held
    yield {"text": "".join(text), "turns": marks, "rewritten": [], "last": True}


def conversations(batches) -> Iterator[tuple[int | None, Iterator[Turn]]]:
    """Consecutive rows of each conversation, read as they are asked for."""
    rows = ((c, (r or "", t or "")) for b in batches for c, r, t in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        conv_id = ahead[0]

        def turns():
            nonlocal ahead
            while ahead is not None and ahead[0] == conv_id:
                yield ahead[1]
                ahead = next(rows, None)

        own = turns()
        yield conv_id, own
        for _ in own:  # what the caller left
            pass


def write(rows: DataFrame, folder: str, template: Template | None = None, loss_roles: tuple[str, ...] = ("assistant",)) -> dict:
    """Format all conversations into JSON lines, one file for each partition."""
    spark, template, roles = rows.sparkSession, template or Marked(), frozenset(loss_roles)
    storage.small_batches(spark)
    ordered = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        from pyspark import TaskContext

        queue = conversations(batches)
        first = next(queue, None)
        if first is None:
            return
        name = f"chat-{TaskContext.get().partitionId():06d}.jsonl"
        n = 0
        with storage.writing(f"{folder}/{name}") as out:
            for conv_id, turns in chained(first, queue):
                for segment in render_conversation(template, turns, roles):
                    out.write((json.dumps({"conv_id": conv_id, **segment}) + "\n").encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"name": [name], "n": [n]})

    files = ordered.mapInArrow(run, "name string, n long").collect()  # a row a file
    manifest = {"files": sorted(r.name for r in files)}
    with storage.writing(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def chained(first, rest):
    yield first
    yield from rest


def lines(source) -> Iterator[bytes]:
    """Lines of a file, read in pieces."""
    rest = b""
    while data := source.read(1 << 20):
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def read(spark: SparkSession, folder: str, template: Template | None = None) -> DataFrame:
    """Read the files back: digests of turns and of the text under the loss mask for each conversation."""
    template = template or Marked()
    with storage.reading(f"{folder}/manifest.json") as source:
        files = json.loads(source.read())["files"]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewritten"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, state = [], None
                with storage.reading(f"{folder}/{name}") as source:
                    for line in lines(source):
                        part = json.loads(line)
                        state = state or [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                        text = part["text"]
                        for k, (begin, _, low, high, loss) in enumerate(part["turns"]):
                            if low is None:
                                raise ValueError("the template hides a turn's text")
                            content = template.unescape(text[low:high])
                            role = part["roles"][k] if "roles" in part else template.role(text[begin:low])
                            state[1].update(f"{role}\n{content}\n".encode())
                            if loss:
                                state[2] += len(content)
                                state[3].update(content.encode())
                        state[0] += len(part["turns"])
                        state[4] += len(text)
                        state[5] += len(part["rewritten"])
                        if part["last"]:
                            out.append([part["conv_id"], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:]])
                            state = None
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * 7, kinds, strict=True)], names)

    listed = spark.createDataFrame([(f,) for f in files], "name string").repartition(max(1, len(files)))
    return listed.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_rewritten long")
