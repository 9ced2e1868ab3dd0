"""Fill-in-the-middle examples made by a pipeline of pyarrow.compute calls.

A text is cut into lines, each with its line break.  Two cuts, drawn from a hash of
the doc_id, part the lines into a prefix, a middle and a suffix, which are written
in one of two orders behind marks:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

Every Arrow batch is handled as whole columns: the texts are split into list
arrays, flattened beside the row that each line comes from, numbered within their
row, filtered by their role, made lists again and joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, refuse_clashes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Of a hundred texts, those that are transformed, and of these, those in the order spm.
RATE, SPM = 100, 50
#: Bytes of text handled at once; a longer text is handled by itself.
PIECE = 8 << 20


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from the sha256 of `seed:doc_id`; a null doc_id reads `null`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _modulo(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _joined(units: pa.Array, role: pa.Array, which: int, counts: pa.Array) -> pa.Array:
    """The units of one role, joined by row; `counts` of them belong to each row."""
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(units, pc.equal(role, which))), "")


def fim_columns(text: pa.Array, h: list[pa.Array], rate: int = RATE, spm: int = SPM) -> dict[str, pa.Array]:
    """n, form, prefix, middle, suffix and output of each text; the pieces are null where the form is plain."""
    text = pc.fill_null(text, "")
    pieces = pc.split_pattern(text, "\n")
    parent, flat = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    per_row = pc.list_value_length(pieces).cast(pa.int64())
    starts = pc.subtract(pc.cumulative_sum(per_row), per_row)
    ordinal = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.take(starts, parent))
    # what follows the last line break has none, and is no line where it is empty
    is_last = pc.equal(ordinal, pc.subtract(pc.take(per_row, parent), 1))
    kept = pc.invert(pc.and_(is_last, pc.equal(flat, "")))
    units = pc.binary_join_element_wise(flat, pc.if_else(is_last, "", "\n"), "")
    units, parent, ordinal = (pc.filter(x, kept) for x in (units, parent, ordinal))
    n = pc.subtract(per_row, pc.or_(pc.ends_with(text, "\n"), pc.equal(text, "")).cast(pa.int64()))

    cuts = [_modulo(x, pc.add(n, 1)) for x in h[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    role = pc.add(pc.greater_equal(ordinal, pc.take(low, parent)).cast(pa.int8()), pc.greater_equal(ordinal, pc.take(high, parent)).cast(pa.int8()))
    prefix, middle, suffix = (_joined(units, role, k, c) for k, c in enumerate((low, pc.subtract(high, low), pc.subtract(n, high))))

    marked = pc.or_(pc.or_(*(pc.match_substring(text, m) for m in (PREFIX, SUFFIX))), pc.match_substring(text, MIDDLE))
    plain = pc.or_(pc.or_(pc.equal(text, ""), marked), pc.greater_equal(_modulo(h[2], 100), rate))
    first_suffix = pc.less(_modulo(h[3], 100), spm)
    form = pc.if_else(plain, "plain", pc.if_else(first_suffix, "spm", "psm"))
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    turned = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    output = pc.if_else(plain, text, pc.if_else(first_suffix, turned, psm))
    none = pa.scalar(None, pa.string())
    return {"n": n, "form": form, "prefix": pc.if_else(plain, none, prefix), "middle": pc.if_else(plain, none, middle), "suffix": pc.if_else(plain, none, suffix), "output": output}


def _row_ranges(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about PIECE bytes of text."""
    upto = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + PIECE, side="right")) - 1)
        yield i, j
        i = j


def with_fim(docs: DataFrame, keep: list[str] | None = None, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """`docs` (doc_id, text and any other columns) with n, form, prefix, middle, suffix and output.

    n counts the lines, `form` is psm, spm or plain.  A text is plain, and its
    output the text itself, where it is null or empty, where it holds one of the
    marks, and in 100 - `rate` of a hundred cases; its pieces are null then.  Equal
    doc_ids draw equal cuts of as many lines, so repeated rows come out alike; a
    null doc_id draws as `null` does.  Texts of any length are handled whole, an
    empty table gives an empty one, and a column of `docs` with a name of the
    added ones raises.  `keep` names the added columns wanted (all if None).
    """
    kinds = {"n": T.LongType(), **{c: T.StringType() for c in ("form", "prefix", "middle", "suffix", "output")}}
    wanted = list(kinds) if keep is None else keep
    refuse_clashes(docs, *wanted)
    names = [free_name(docs, f"__h{k}") for k in range(4)]
    own = docs.columns
    source = "text" if isinstance(docs.schema["text"].dataType, T.StringType) else free_name(docs, "__fim_text")
    added = [] if source == "text" else [F.col("text").cast("string").alias(source)]
    first = len(own) + len(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(source))
            for i, j in _row_ranges(text):
                some = batch.slice(i, j - i)
                made = fim_columns(text.slice(i, j - i), some.columns[first:], rate, spm)
                yield pa.RecordBatch.from_arrays([*some.columns[: len(own)], *(made[c] for c in wanted)], [*own, *wanted])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, kinds[c]) for c in wanted)])
    drawn = docs.select("*", *added, *[h.alias(name) for h, name in zip(draws(F.col("doc_id"), seed), names, strict=True)])
    return drawn.mapInArrow(run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output of `with_fim` was made of.

    No piece of a marked output holds a mark, and none can arise where a piece meets
    one, so the first of each mark is the one that was written.
    """
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    part = lambda text, mark, k: F.split_part(text, F.lit(mark), F.lit(k))
    rest = part(body, SUFFIX, 2)
    psm = F.concat(part(body, SUFFIX, 1), part(rest, MIDDLE, 2), part(rest, MIDDLE, 1))
    rest = part(body, PREFIX, 2)
    spm = F.concat(part(rest, MIDDLE, 1), part(rest, MIDDLE, 2), part(body, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every row of `docs`."""
    made = with_fim(docs.select("doc_id", F.col("text").cast("string").alias("text")), ["n", "form", "prefix", "middle", "output"])
    return made.select(
        "doc_id",
        "n",
        "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
