"""Transcripts to canonical chat turns: roles by a hidden Markov model.

The turns of a conversation are the observations, the roles the hidden states.  A
turn starts where its row starts or where a line carries a speaker marker ("User:",
"### Assistant", "<|system|>" and the like).  It is observed through its marker, the
kind of its first line (blank, question, list, code, text) with its length, and the
kinds of its later lines; the label of the row that it came with is one more
observation, or is hidden.  Start, transition, marker and line probabilities are
counted over labelled rows, with a small prior each.  Viterbi gives the most probable
roles.

Long conversations are no single task's work.  Rows are range-partitioned by
conversation and place, read once and kept as chunks of about CHUNK_BYTES of text with
the features of their turns; no later step shuffles text.  A chunk reduces its stretch
of a conversation that crosses chunks to the max-plus product of its transition
scores.  Products are chained within a range partition and then over partitions, which
fixes the states at the ends of every chunk, and each chunk decodes its own stretch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, discard, stored

ROLES = ("system", "user", "assistant")
#: Labels and markers that name a role, in lower case. Fixed values.
NAMES = {
    "system": 0, "sys": 0, "developer": 0, "instruction": 0, "context": 0,
    "user": 1, "human": 1, "prompter": 1, "question": 1, "q": 1, "customer": 1, "me": 1, "you": 1,
    "assistant": 2, "ai": 2, "bot": 2, "gpt": 2, "model": 2, "answer": 2, "a": 2, "agent": 2, "response": 2,
}
_WORD = "|".join(sorted(NAMES, key=len, reverse=True))
_MARKER = re.compile(rf"\s*(?:<\|(?:im_start\|>)?({_WORD})(?:\|>)?|#{{1,4}}\s*({_WORD})\s*:?\s*$|\[({_WORD})\]:?|\**({_WORD})\**\s*:\**)\s*", re.I)
_END = re.compile(r"\s*<\|(?:im_end|eot_id|end|endoftext)\|>\s*")
_LIST = re.compile(r"\s*(?:[-*•]\s|\d+[.)]\s)")
_CODE = re.compile(r"\s*```|(?:    |\t)\S|.*[{};]\s*$")
LABELS, MARKERS, KINDS, SIZES = len(ROLES) + 1, len(ROLES) + 1, 5, 24
RENDERED = "<|im_start|>{}\n{}<|im_end|>\n"
#: How often a row's label is right, where labels are observed.
TRUST = 0.99
#: Bytes of text for which one range partition is made, and those of a chunk.
PART_BYTES, CHUNK_BYTES = 256 << 20, 1 << 20
UNLABELLED, STARTS, UNKNOWN = -1, -2, -3
#: What a turn's features are, as integers: label, marker, first line and size, kinds of later lines.
FEATURES = 3 + KINDS


def role_of(label: str | None) -> int:
    return NAMES.get((label or "").strip().lower(), LABELS - 1)


def _kind(body: str, bare: str) -> int:
    if not bare:
        return 0
    if bare[-1] in "?？":
        return 1
    if _LIST.match(body):
        return 2
    return 3 if bare[-1] in "{};" or bare.startswith("```") or _CODE.match(body) else 4


def turns_of(text: str | None, label: str | None) -> tuple[list[str], list[list[int]]]:
    """The bodies of a row's turns, without markers, and their features; the label counts for the first turn."""
    bodies: list[list[str]] = []
    features: list[list[int]] = []
    for k, line in enumerate((text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")):
        m = _MARKER.match(line) if ":" in line or "<" in line or "#" in line or "[" in line else None
        body = line[m.end() :] if m else line
        if "<|" in body:
            body = _END.sub("", body)
        kind = _kind(body, body.strip())
        if k == 0 or m:
            mark = NAMES[next(g for g in m.groups() if g).lower()] if m else MARKERS - 1
            features.append([role_of(label) if k == 0 else LABELS - 1, mark, kind, *[0] * KINDS])
            bodies.append([body])
        else:
            features[-1][3 + kind] += 1
            bodies[-1].append(body)
    done = ["\n".join(b).strip() for b in bodies]
    for f, b in zip(features, done, strict=True):
        f[2] = f[2] * SIZES + min(SIZES - 1, (len(b) * len(b)).bit_length())
    return done, features


class Model:
    """Log probabilities; see the module's text."""

    def __init__(self, counts: dict[tuple[str, int, int], int], trust: float | None = TRUST) -> None:
        def table(name: str, prior: np.ndarray) -> np.ndarray:
            t = prior.astype(float)
            for (n, a, b), c in counts.items():
                if n == name:
                    t[a, b] += c
            return np.log(t / t.sum(axis=1, keepdims=True))

        n = len(ROLES)
        self.start = table("start", np.ones((1, n)))[0]
        self.turn = table("turn", np.ones((n, n)))
        self.kind = table("kind", np.ones((n, KINDS)))
        self.first = table("first", np.ones((n, KINDS * SIZES)))
        # before any count a marker is wrong once in a hundred and as likely as none
        self.mark = table("mark", np.column_stack([np.full((n, n), 0.01) + 0.98 * np.eye(n), np.ones(n)]))
        # a label is right by `trust`; None hides it
        said = np.zeros((n, n + 1))
        if trust is not None:
            said[:, :n] = np.log((1 - trust) / (n - 1))
            np.fill_diagonal(said, np.log(trust))
        self.said = said

    def scores(self, features: np.ndarray) -> np.ndarray:
        """The log probability of each turn's observations under each role."""
        f = features.astype(np.int64)
        return (self.said[:, f[:, 0]] + self.mark[:, f[:, 1]] + self.first[:, f[:, 2]]).T + f[:, 3:] @ self.kind.T


def learns(conv: int | None) -> bool:
    """Conversations from which a model with hidden labels learns: those whose crc32 leaves 0 or 2 on division by 3."""
    return conv is not None and crc32(str(conv).encode()) % 3 != 1


def _product(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    return b if a is None else (a[:, :, None] + b[None, :, :]).max(axis=1)


def _product_of(mats: np.ndarray) -> np.ndarray:
    """The max-plus product of a stack of matrices, in order."""
    while len(mats) > 1:
        even, odd = mats[: len(mats) // 2 * 2 : 2], mats[1::2]
        mats = np.concatenate([(even[:, :, :, None] + odd[:, None, :, :]).max(axis=2), mats[len(mats) // 2 * 2 :]])
    return mats[0]


_CHUNK = "chunk long, part int, lead int, conv array<long>, turn array<long>, role array<string>, copies array<long>, n array<int>, features binary, body array<string>"


def _chunks(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """Sorted rows as chunks: a record with the rows' columns, the number of turns of each, and the turns' features and bodies.

    lead is what comes before the chunk's first row: the label of the row before in
    its conversation, else UNLABELLED, STARTS (a new conversation) or UNKNOWN, where
    another partition would have to tell.
    """
    names = [c.split()[0] for c in _CHUNK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[list] = [[] for _ in range(7)]
        size, before, last = 0, UNKNOWN if part else STARTS, None

        def chunk() -> pa.RecordBatch:
            conv, turn, role, copies, n, features, body = held
            flat = np.array(features, dtype=np.int32).reshape(-1, FEATURES).tobytes()
            values = ((part << 32) + number, part, before, conv, turn, role, copies, n, flat, body)
            kinds = [pa.int64(), pa.int32(), pa.int32(), *map(pa.list_, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32())), pa.binary(), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not size and last is not None:
                    before = last[1] if last[0] == conv else STARTS
                bodies, features = turns_of(text, role)
                last = (conv, features[0][0] if len(bodies) == 1 and features[0][0] < len(ROLES) else UNLABELLED)
                for column, value in zip(held, (conv, turn, role, copies, len(bodies)), strict=False):
                    column.append(value)
                held[5] += features
                held[6] += bodies
                size += len(text or "") + 64
                if size >= chunk_bytes:
                    yield chunk()
                    held, size, number = [[] for _ in range(7)], 0, number + 1
        if size:
            yield chunk()

    return rows.mapInArrow(run, _CHUNK)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The chunks of a partition, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            one = {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            one["features"] = np.frombuffer(one["features"], np.int32).reshape(-1, FEATURES)
            one["cuts"] = np.concatenate([[0], np.cumsum(one["n"])]).astype(int)
            yield one


def _stretches(conv: list) -> list[tuple[int, int]]:
    """The runs of rows of one conversation."""
    cuts = [k for k in range(len(conv)) if k == 0 or conv[k] != conv[k - 1]]
    return list(zip(cuts, [*cuts[1:], len(conv)], strict=True))


def _counts(chunks: DataFrame, use: Callable[[int | None], bool]) -> dict[tuple[str, int, int], int]:
    """How often labelled rows start, follow each other and show their features; pairs over a partition's bounds aren't counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int, int], int] = {}

        def add(name: str, a: int, b: int, n: int = 1) -> None:
            seen[name, a, b] = seen.get((name, a, b), 0) + n

        for c in _records(batches):
            for i, (a, b) in enumerate(_stretches(c["conv"])):
                if not use(c["conv"][a]):
                    continue
                before = STARTS if i else c["lead"]
                for r in range(a, b):
                    label, mark, first, *kinds = c["features"][c["cuts"][r]].tolist()
                    if label < len(ROLES):
                        if before == STARTS:
                            add("start", 0, label)
                        elif before >= 0:
                            add("turn", before, label)
                        add("mark", label, mark)
                        add("first", label, first)
                        for kind, n in enumerate(kinds):
                            if n:
                                add("kind", label, kind, n)
                    before = label if label < len(ROLES) and c["n"][r] == 1 else UNLABELLED
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in seen], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))] + [pa.array(list(seen.values()), pa.int64())], ["name", "a", "b", "n"])

    total = chunks.select("lead", "conv", "n", "features").mapInArrow(run, "name string, a int, b int, n long").groupBy("name", "a", "b").agg(F.sum("n").alias("n"))
    return {(r["name"], r["a"], r["b"]): r["n"] for r in total.collect()}  # at most a few hundred


_ENDS = "conv long, named boolean, part int, before int, last int"


def _ends(chunks: DataFrame, model: Model) -> DataFrame:
    """(chunk, ends): the role before and the last role of each stretch of a chunk whose conversation crosses chunks."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for c in _records(batches):
            runs = _stretches(c["conv"])
            for a, b in {runs[0], runs[-1]}:  # only the first and the last conversation can go on elsewhere
                s = model.scores(c["features"][c["cuts"][a] : c["cuts"][b]])
                rest = _product_of(model.turn[None] + s[1:, None, :]).tobytes() if len(s) > 1 else b""
                out.append((c["chunk"], c["part"], c["conv"][a] or 0, c["conv"][a] is not None, s[0].tobytes(), rest))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["chunk", "part", "conv", "named", "firsts", "rest"])

    keys = ["conv", "named"]
    base = stored(chunks.select("chunk", "part", "conv", "n", "features").mapInArrow(pieces, "chunk long, part int, conv long, named boolean, firsts binary, rest binary"), "stretches")
    crossing = base.groupBy(*keys).agg(F.count("*").alias("_m")).where("_m > 1").select(*keys)
    every = base.join(crossing, keys, "left_semi")

    def whole(own: pd.DataFrame) -> pd.DataFrame:
        """One stretch of a partition from those of its chunks."""
        own = own.sort_values("chunk")
        mats = [np.frombuffer(own["rest"].iloc[0]).reshape(3, 3)] if own["rest"].iloc[0] else []
        for firsts, rest in zip(own["firsts"].iloc[1:], own["rest"].iloc[1:], strict=True):
            mats.append(model.turn + np.frombuffer(firsts)[None, :])
            mats += [np.frombuffer(rest).reshape(3, 3)] if rest else []
        rest = _product_of(np.array(mats)).tobytes() if mats else b""
        return pd.DataFrame({"conv": own["conv"].iloc[:1], "named": own["named"].iloc[:1], "part": own["part"].iloc[:1], "firsts": [own["firsts"].iloc[0]], "rest": [rest]})

    def over_parts(own: pd.DataFrame) -> pd.DataFrame:
        fixed = _chain(model, [(r.part, 0, r.firsts, r.rest) for r in own.itertuples()])
        rows = [(own["conv"].iloc[0], own["named"].iloc[0], part, before, last) for (part, _), (before, last) in fixed.items()]
        return pd.DataFrame(rows, columns=["conv", "named", "part", "before", "last"]).astype({"before": "Int32"})

    def over_chunks(own: pd.DataFrame) -> pd.DataFrame:
        before = own["part_before"].iloc[0]
        fixed = _chain(model, [(r.chunk, 0, r.firsts, r.rest) for r in own.itertuples()], None if pd.isna(before) else int(before), int(own["part_last"].iloc[0]))
        rows = [(chunk, own["conv"].iloc[0], own["named"].iloc[0], b, last) for (chunk, _), (b, last) in fixed.items()]
        return pd.DataFrame(rows, columns=["chunk", "conv", "named", "before", "last"]).astype({"before": "Int32"})

    parts = every.groupBy(*keys, "part").applyInPandas(whole, "conv long, named boolean, part int, firsts binary, rest binary")
    fixed = parts.groupBy(*keys).applyInPandas(over_parts, _ENDS)
    inside = every.join(fixed.withColumnsRenamed({"before": "part_before", "last": "part_last"}), [*keys, "part"])
    ends = inside.groupBy(*keys, "part").applyInPandas(over_chunks, "chunk long, conv long, named boolean, before int, last int")
    done = stored(ends.groupBy("chunk").agg(F.collect_list(F.struct("conv", "named", "before", "last")).alias("ends")), "ends")
    discard(base)
    # two conversations of a chunk at most: about a hundred bytes a row
    return F.broadcast(done) if done.count() * 100 <= BROADCAST_BYTES else done


def canonical_turns(conversations: DataFrame, part_bytes: int = PART_BYTES, chunk_bytes: int = CHUNK_BYTES, labels: str = "seen") -> DataFrame:
    """One row for each canonical turn: conv_id, turn, part, given_role, role, text, rendered, n_copies.

    `conversations` has conv_id, turn, role and text; other columns are ignored.
    role may be null or any name, then the model decides.  With labels="seen" a
    known role is an observation that is right by TRUST, and the model learns from
    all of them; with labels="hidden" it decodes without them and learns from the
    conversations of `learns` only.  given_role is the row's own role as it came.

    A row whose lines hold markers gives several turns, numbered by part from 0.  A
    null or empty text is an empty turn.  Rows are in the order of turn (nulls
    first), role and a hash of the text; equal rows are one turn whose n_copies is
    their number.  Rows without conv_id are one conversation.  A text of any length
    is one row's work.  The rendered turns of a conversation, in order, are its
    transcript.  An empty table gives an empty result.
    """
    if labels not in ("seen", "hidden"):
        raise ValueError("labels is 'seen' or 'hidden'")
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    # copies meet before the rows are dealt, so that a common row is no partition's load
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n_copies"))
    order = ["conv_id", "turn", "role", "_text"]
    ranged = rows.withColumn("_text", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    chunks = stored(_chunks(ranged.select("conv_id", "turn", "role", "text", "n_copies"), chunk_bytes), "turns")
    hides = labels == "hidden"
    model = Model(_counts(chunks, learns if hides else lambda conv: True), None if hides else TRUST)
    joined = chunks.join(_ends(chunks, model), "chunk", "left").select("conv", "turn", "role", "copies", "n", "features", "body", "ends")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _records(batches):
            ends = {e["conv"] if e["named"] else None: (e["before"], e["last"]) for e in c["ends"] or []}
            found: list[int] = []
            for a, b in _stretches(c["conv"]):
                scores = model.scores(c["features"][c["cuts"][a] : c["cuts"][b]])
                found += _viterbi(model, list(scores), *ends.get(c["conv"][a], (None, None)))
            row = np.repeat(np.arange(len(c["n"])), c["n"])
            of = lambda name, kind: pa.array(c[name], kind).take(pa.array(row))
            names = [ROLES[r] for r in found]
            part = np.arange(len(row)) - c["cuts"][row]
            shown = [RENDERED.format(r, b) for r, b in zip(names, c["body"], strict=True)]
            cols = [of("conv", pa.int64()), of("turn", pa.int64()), pa.array(part, pa.int32()), of("role", pa.string()), pa.array(names, pa.string()), pa.array(c["body"], pa.string()), pa.array(shown, pa.string()), of("copies", pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["conv_id", "turn", "part", "given_role", "role", "text", "rendered", "n_copies"])

    return joined.mapInArrow(decode, "conv_id long, turn long, part int, given_role string, role string, text string, rendered string, n_copies long")


def _viterbi(model: Model, scores: list[np.ndarray], before: int | None, last: int | None) -> list[int]:
    """The best roles of consecutive turns, after the role `before` and with the last role given, where known."""
    best = [scores[0] + (model.start if before is None else model.turn[before])]
    back = []
    for s in scores[1:]:
        step = best[-1][:, None] + model.turn
        back.append(step.argmax(axis=0))
        best.append(step.max(axis=0) + s)
    path = [int(best[-1].argmax()) if last is None else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _chain(model: Model, pieces: list, before: int | None = None, last: int | None = None) -> dict[tuple[int, int | None], tuple[int | None, int]]:
    """(role before, last role) of every stretch (place, conversation, firsts, rest), after a role and up to a last one where known."""
    by_conv: dict[int | None, list] = {}
    for part, conv, firsts, rest in pieces:
        n = len(ROLES)
        by_conv.setdefault(conv, []).append((part, np.frombuffer(firsts), np.frombuffer(rest).reshape(n, n) if rest else np.where(np.eye(n) > 0, 0.0, -np.inf)))
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda p: p[0])
        best, backs = None, []
        for _, firsts, rest in own:
            into = (model.start if before is None else model.turn[before])[None, :] if best is None else best[:, None] + model.turn
            enter = into + firsts[None, :]
            step = enter.max(axis=0)[:, None] + rest
            backs.append((enter.argmax(axis=0), step.argmax(axis=0)))
            best = step.max(axis=0)
        now = int(best.argmax()) if last is None else last
        for k in range(len(own) - 1, -1, -1):
            came, first = backs[k]
            into = int(came[first[now]]) if k else before
            out[own[k][0], conv] = (into, now)
            now = into
    return out
