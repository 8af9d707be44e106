r"""Fill-in-the-middle: texts cut into prefix, middle and suffix by code points, with a pipeline of Arrow kernels.

Units are code points. Per batch, texts become list arrays of units over the same bytes; the lists are flattened with
parent indices, each unit gets its ordinal within its text and, from the two cuts, its role (prefix, middle, suffix);
units are filtered by role, rebuilt into lists and joined to strings. Work goes on in chunks of `CHUNK` bytes, so a long
text costs memory for its own bytes only; its pieces are joined by the same kernels.

Cuts and form come from the sha256 of `<seed>:<doc_id>`, so reruns and other partitions agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from echoloom.llm import shared, words

SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK = 1 << 19
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")
_CUTS = ("__echoloom_low", "__echoloom_high")


def _chunks(data, offsets):
    """(first text, its units as lists by text) over runs of whole code points."""
    at = 0
    while at < len(data):
        stop = min(at + CHUNK, len(data))
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop += 1
        part = data[at:stop]
        starts = np.flatnonzero((part & 0xC0) != 0x80).astype(np.int32)
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        last = int(np.searchsorted(offsets, stop, side="left"))
        bounds = np.searchsorted(starts, np.clip(offsets[first:last + 1] - at, 0, stop - at)).astype(np.int32)
        units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, np.int32(len(part)))), pa.py_buffer(part))
        yield first, pa.ListArray.from_arrays(pa.array(bounds), units)
        at = stop


def _joined(values, parents, n: int):
    """Strings joined by parent, in order; one for each of `n` parents."""
    sizes = np.bincount(parents.to_numpy(zero_copy_only=False), minlength=n)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), values)
    return pc.binary_join(lists, pa.scalar("", values.type))


def roles(column, low, high):
    """[prefixes, middles, suffixes] of a text column cut before the units numbered `low` and `high`."""
    data, offsets = words.buffers(column)
    n = len(offsets) - 1
    kinds, found, seen, counts = 3, [], 0, np.zeros(n, np.int64)
    for first, lists in _chunks(data, offsets):
        parents = pc.add(pc.list_parent_indices(lists).cast(pa.int64()), first)
        units, size = pc.list_flatten(lists), len(lists.flatten())
        here = np.bincount(parents.to_numpy(zero_copy_only=False) - first, minlength=len(lists))
        # ordinals go on where the chunk before left the text
        begin = seen + np.concatenate([[0], np.cumsum(here)[:-1]]) - counts[first:first + len(lists)]
        ordinals = pc.subtract(pa.array(np.arange(seen, seen + size)), pc.take(pa.array(begin), pc.subtract(parents, first)))
        role = pc.add(pc.greater_equal(ordinals, pc.take(low, parents)).cast(pa.int8()),
                      pc.greater_equal(ordinals, pc.take(high, parents)).cast(pa.int8()))
        local = pc.subtract(parents, first)
        of = []
        for k in range(kinds):
            mask = pc.equal(role, k)
            of.append(_joined(units.filter(mask), local.filter(mask), len(lists)))
        found.append((np.arange(first, first + len(lists)), of))
        counts[first:first + len(lists)] += here
        seen += size
    at = pa.array(np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64))
    return [_joined(pa.concat_arrays([f[1][k].cast(pa.large_string()) for f in found] or [pa.array([], pa.large_string())]), at, n)
            for k in range(kinds)]


def _formatted(batches):
    for batch in batches:
        for t in words.pieces(batch, "text"):
            low, high = (t.column(c) for c in _CUTS)
            pre, mid, suf = roles(t.column("text"), low, high)
            join = lambda *parts: pc.binary_join_element_wise(*[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p
                                                                for p in parts], pa.scalar("", pa.large_string()))
            form = t.column("form")
            text = t.column("text").cast(pa.large_string()).fill_null("")
            out = pc.if_else(pc.equal(form, "psm"), join(PREFIX, pre, SUFFIX, suf, MIDDLE, mid),
                             pc.if_else(pc.equal(form, "spm"), join(SUFFIX, suf, PREFIX, pre, MIDDLE, mid), text))
            names = [c for c in t.schema.names if c not in _CUTS]
            yield pa.RecordBatch.from_arrays([*[t.column(c) for c in names], out.cast(pa.string())], [*names, "output"])


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """`docs` with n (code points), form (psm, spm or plain), prefix_chars, middle_chars and `output`; such columns are replaced.

    A text stays plain, with null lengths, if it is empty or null (output: empty), holds a marker, or by its hash. Rows
    with one doc_id have equal hashes, those with a null doc_id that of an empty one. Whole texts, whatever their
    length; all other columns stay. An empty table stays empty.
    """
    shared.small_batches(docs.sparkSession)
    docs = docs.drop(*ADDED).withColumn("text", F.col("text").cast("string"))
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    n = F.char_length(text).cast("long")
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((n == 0) | marked | (h[2] % 100 >= PLAIN_FROM), "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    low, high = F.least(a, b), F.greatest(a, b)
    rows = docs.select("*", n.alias("n"), form.alias("form"), low.alias(_CUTS[0]), high.alias(_CUTS[1]))
    cut = F.col("form") != "plain"
    rows = rows.withColumn("prefix_chars", F.when(cut, F.col(_CUTS[0]))).withColumn(
        "middle_chars", F.when(cut, F.col(_CUTS[1]) - F.col(_CUTS[0])))
    return rows.mapInArrow(_formatted, rows.drop(*_CUTS).schema.add("output", "string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of. Texts with markers stay plain, so the three markers are the only ones."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2])).when(
        F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(F.col(output))
