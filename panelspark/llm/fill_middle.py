"""Fill-in-middle transformation with pyarrow.compute.

A batch's texts become list arrays of units.  The lists are flattened beside
their parent indices, every unit gets its ordinal in its text and, by the text's
two cut points, a role (prefix, middle or suffix).  For each role the units are
filtered, rebuilt into lists and joined to one piece a text (``binary_join``);
the pieces and their marks are joined element by element in the order of the
text's form.  ``restore`` splits an output at its marks and joins the pieces
in text order again.

Units are code points or words (a run of other characters with the white space
before it; white space at a text's end belongs to its last word), so that the units of
a text always join to the text.

Very long texts are cut into slabs of about ``SLAB`` bytes whose units keep counting where
the slab before ended; the slabs' pieces are joined again by ``binary_join``.  So
the per-unit arrays stay bounded whatever the length of a text.

Cut points and form come from a hash of the document's id alone, so reruns and other
partitionings agree.

Defined cases: a null text counts as empty; an empty text, and one that holds a
mark, stays plain (it could not be told apart from a transformed one); a null
doc_id hashes as the empty text; repeated rows each give the same row again; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import text_chunks

# fixed values: marks, and the shares (of 100) of transformed texts and, among them, of suffix-first ones
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ANY_MARK = "<[PSM]>"
FIM_PERCENT = 90
SPM_PERCENT = 20
SLAB = 1 << 18              # bytes of text whose units are laid out at once
RESULT = ("doc_id bigint, n bigint, form string, prefix_units bigint, middle_units bigint, "
          "output string, restored string")


def unit_starts(buf: np.ndarray, starts: np.ndarray, unit: str) -> np.ndarray:
    """Boolean per byte of the concatenated texts: a unit starts here."""
    if unit == "codepoint":
        return (buf & 0xC0) != 0x80
    if unit != "word":
        raise ValueError(f"unknown unit {unit}")
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    first = space.copy()
    first[1:] &= ~space[:-1]                # white space before a word starts its unit
    at = starts[:-1][starts[:-1] < starts[1:]]
    first[at] = True
    # a text that starts with a word: its first byte starts the unit; trailing white space starts none
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        back = e
        while back > s and space[back - 1]:
            back -= 1
        if back > s:
            first[back:e] = False
        elif e > s:
            first[s + 1:e] = False
    return first


def _pieces(buf, first, slabs, lo, hi):
    """Three arrays (prefix, middle, suffix) with one piece a slab.

    slabs: (byte start, byte end, ordinal of the first unit) per slab, adjacent in ``buf``;
    lo, hi: cut points of the slab's text."""
    a, z = slabs[0][0], slabs[-1][1]
    pos = np.flatnonzero(first[a:z]).astype(np.int32)
    borders = np.array([s for s, _, _ in slabs] + [z]) - a
    lists = np.searchsorted(pos, borders).astype(np.int32)
    offsets = np.append(pos, np.int32(z - a))
    flat_units = pa.StringArray.from_buffers(len(pos), pa.py_buffer(offsets), pa.py_buffer(buf[a:z]))
    units = pa.ListArray.from_arrays(pa.array(lists), flat_units)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    base = pa.array(np.array([n for _, _, n in slabs]) - lists[:-1])
    ordinal = pc.add(pa.array(np.arange(len(pos))), pc.take(base, parent))
    role = pc.add(pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(lo), parent)), pa.int8()),
                  pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(hi), parent)), pa.int8()))
    out = []
    for r in range(3):
        mine = pc.equal(role, pa.scalar(r, pa.int8()))
        per = np.bincount(pc.filter(parent, mine).to_numpy(), minlength=len(slabs))
        rebuilt = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per)).astype(np.int32)), pc.filter(flat, mine))
        out.append(pc.binary_join(rebuilt, ""))
    return out


def cut_texts(texts: pa.Array, units: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, unit: str) -> list[pa.Array]:
    """Prefix, middle and suffix of every text; ``units``: unit starts of its bytes."""
    got: list[list] = [[], [], []]
    owner: list[int] = []
    group: list = []
    for i, starts, buf in text_chunks(texts, SLAB):
        rows = range(i, i + len(starts) - 1)
        first = np.concatenate([units[j] for j in rows]) if len(rows) else np.zeros(0, bool)
        for j, s, e in zip(rows, starts[:-1].tolist(), starts[1:].tolist()):
            n = 0
            while True:                     # slabs of one text, cut where a unit starts
                z = e
                if e - s > 2 * SLAB:
                    ahead = np.flatnonzero(first[s + SLAB:e])
                    z = s + SLAB + int(ahead[0]) if len(ahead) else e
                group.append((j, s, z, n))
                if z == e:
                    break
                n += int(np.count_nonzero(first[s:z]))
                s = z
        while group:
            take = 1
            while take < len(group) and group[take][2] - group[0][1] <= 2 * SLAB:
                take += 1
            now, group = group[:take], group[take:]
            who = np.array([j for j, _, _, _ in now])
            for r, piece in enumerate(_pieces(buf, first, [x[1:] for x in now], lo[who], hi[who])):
                got[r].append(piece)
            owner += who.tolist()
    if not owner:
        return [pa.array([], pa.string())] * 3
    per = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))).astype(np.int32)
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array(per), pa.concat_arrays(g)), "") for g in got]


def restore(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that the outputs were made of, from output and form alone."""
    text = output
    for name, order in (("psm", (1, 3, 2)), ("spm", (2, 3, 1))):
        mine = pc.equal(form, name)
        # no piece holds a mark, so every output splits into an empty head and three pieces
        parts = pc.split_pattern_regex(pc.filter(output, mine), ANY_MARK)
        if len(parts):
            joined = pc.binary_join_element_wise(*[pc.list_element(parts, k) for k in order], "")
            text = pc.replace_with_mask(text, mine, joined)
    return text


def _transform(unit: str, fim_percent: int, spm_percent: int):
    def run(batches):
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            h = [batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5)]
            units: list[np.ndarray] = []
            for _, starts, buf in text_chunks(text):
                first = unit_starts(buf, starts, unit)
                units += [first[s:e] for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())]
            n = np.array([np.count_nonzero(u) for u in units], np.int64)
            plain = (n == 0) | (h[2] % 100 >= fim_percent)
            plain |= pc.match_substring_regex(text, ANY_MARK).to_numpy(zero_copy_only=False).astype(bool)
            x, y = h[0] % (n + 1), h[1] % (n + 1)
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            work = np.flatnonzero(~plain)
            spm = h[3][work] % 100 < spm_percent
            form = np.full(len(n), "plain", object)
            form[work] = np.where(spm, "spm", "psm")
            p, m, s = cut_texts(text.take(pa.array(work)), [units[j] for j in work], lo[work], hi[work], unit)
            first_mark = pa.array(np.where(spm, SUFFIX, PREFIX), pa.string())
            second_mark = pa.array(np.where(spm, PREFIX, SUFFIX), pa.string())
            made = pc.binary_join_element_wise(first_mark, pc.if_else(pa.array(spm), s, p), second_mark,
                                               pc.if_else(pa.array(spm), p, s), MIDDLE, m, "")
            cut = pa.array(~plain)
            output = pc.replace_with_mask(text, cut, made) if len(work) else text
            forms = pa.array(form, pa.string())
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), forms, pc.if_else(cut, pa.array(lo), none),
                 pc.if_else(cut, pa.array(hi - lo), none), output, restore(output, forms)],
                ["doc_id", "n", "form", "prefix_units", "middle_units", "output", "restored"])
    return run


def id_hashes(doc_id: Column, seed: str) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of ``seed:doc_id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "codepoint", seed: str = "1", fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units of the text), form (plain, psm or spm), prefix_units, middle_units
    (null where plain), output and restored (the text rebuilt from output and form).

    One pass over the documents, no shuffle."""
    h = id_hashes(F.col("doc_id"), seed)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                       *[x.alias(f"h{i + 1}") for i, x in enumerate(h)])
    return rows.mapInArrow(_transform(unit, fim_percent, spm_percent), RESULT)
