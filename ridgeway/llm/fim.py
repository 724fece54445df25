"""Fill-in-middle: a text cut into prefix, middle and suffix and written in another order.

A unit is a code point. Two cuts and the form are drawn from the id, so they are the same in
every run. The form is ``plain`` (the text as it is) where the text is empty, holds one of the
marks, or is drawn so; ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is
``<S>`` suffix ``<P>`` prefix ``<M>`` middle. No mark can begin inside a piece, so the first
``<S>`` (``<P>``), and the first ``<M>`` after it, end the pieces: :func:`restored` gives the text back.

In a batch the texts become a list array of their units, which is flattened beside the number of
each unit's text; the unit's ordinal tells its role; the units of a role are filtered, put into
lists per text again, joined to pieces, and the pieces are joined in the order of the form.
All of it is Arrow compute on slices of bounded bytes; no row leaves its task.

Defined cases: a null text is empty and plain; a null id is drawn as ``1:``; texts of any length
are cut whole (one long text is a slice of its own); equal rows give equal rows; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import bounded_slices, raw_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many, at the end of the range, stay plain; of the others so many are spm.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: A unit costs some forty bytes on its way through the lists.
SLICE = 1 << 20


def draws(doc_id: Column) -> list[Column]:
    """Four numbers below 2^32 that only the id decides: the first digits of a sha256."""
    key = F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units(texts: pa.Array) -> pa.ListArray:
    """The code points of each text (no nulls) as a list of one-character strings."""
    data, bounds = raw_bytes(texts)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    offsets = np.append(starts, len(data)).astype(np.int32)
    chars = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, bounds).astype(np.int32)), chars)


def pieces(texts: pa.Array, first: pa.Array, last: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut after ``first`` and ``last`` units."""
    lists = units(texts)
    chars, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begin = lists.offsets.take(parent).cast(pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(chars))), begin)
    early = pc.less(ordinal, first.take(parent))
    late = pc.greater_equal(ordinal, last.take(parent))
    out = []
    for role in (early, pc.invert(pc.or_(early, late)), late):
        owners = parent.filter(role).to_numpy(zero_copy_only=False)
        ends = np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), chars.filter(role)), "")
        out.append(joined)
    return out


def _marked(texts: pa.Array) -> pa.Array:
    found = [pc.match_substring(texts, mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
    return pc.or_(pc.or_(found[0], found[1]), found[2])


def transformed(texts: pa.Array, h: list[pa.Array]) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of each text, from the four draws."""
    texts = texts.fill_null("")
    n = pc.utf8_length(texts).cast(pa.int64())
    cuts = [_remainder(x, pc.add(n, 1)) for x in h[:2]]
    first, last = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    stays = pc.greater_equal(_remainder(h[2], 100), 100 - PLAIN_PERCENT)
    plain = pc.or_(pc.or_(pc.equal(n, 0), _marked(texts)), stays)
    spm = pc.less(_remainder(h[3], 100), SPM_PERCENT)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    prefix, middle, suffix = pieces(texts, first, last)
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    other = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    none = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": form,
        "prefix_chars": pc.if_else(plain, none, first),
        "middle_chars": pc.if_else(plain, none, pc.subtract(last, first)),
        "output": pc.if_else(plain, texts, pc.if_else(spm, other, psm)),
    }


def _remainder(x: pa.Array, by) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_slices(batches, most=SLICE):
            done = transformed(part.column(1), [part.column(2 + i) for i in range(4)])
            yield pa.RecordBatch.from_arrays([part.column(0), *done.values()], ["doc_id", *done])

    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(F.col(doc_id)))]
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), *drawn)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` has turned into ``output`` of that form."""

    def split(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(first) + 1, F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(rest))

    prefix, suffix, middle = split(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = split(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix2, middle2, suffix2))
        .otherwise(output)
    )


def digests(docs: DataFrame) -> DataFrame:
    """:func:`fill_in_middle` with digests of the output and of the text rebuilt from it."""
    done = fill_in_middle(docs)
    back = restored(F.col("output"), F.col("form"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )
