"""Fill-in-the-middle: texts are cut in three and written with the middle last, by displacement scatter.

The texts of a batch are one flat byte array. A scan finds where tokens end and so where each
text is cut. A difference array holds, where a part begins, by how much its shift differs from
that of the part before; its running sum is the shift of every byte, and one scatter writes all
outputs of the batch. The marks in an output give its parts back, and the inverse gather their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import portions

# Fixed values, given by the contract.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
SEED, RATE, SPM_SHARE = 42, 50, 80

PARTS = ("prefix", "middle", "suffix")
FORMS = ("plain", *ORDERS)
MARK = len(MARKS["prefix"])
BYTES_AT_ONCE = 1 << 22  # of several texts
STEP = 1 << 20  # bytes whose shifts are in memory at a time
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Flat:
    """The values of a string column: all bytes in one array, and where each value begins and ends."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def flat(column: pa.Array | pa.ChunkedArray) -> Flat:
    """A null is an empty value."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return Flat(raw, bounds[:-1], bounds[1:])


def column_of(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The reverse of ``flat``: a string column over the bytes."""
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))


def steps(total: int) -> Iterator[tuple[int, int]]:
    for i in range(0, total, STEP):
        yield i, min(total, i + STEP)


def places(data: np.ndarray, holds: Callable[[np.ndarray, np.ndarray], np.ndarray], beyond: int) -> np.ndarray:
    """Where ``holds`` is true of the bytes from there on and a copy that is ``beyond`` bytes longer."""
    found = [np.zeros(0, dtype=np.int64)]
    for i, j in steps(len(data)):
        found.append(np.flatnonzero(holds(data[i:j], data[i : j + beyond])) + i)
    return np.concatenate(found)


def token_ends(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ends of the tokens of all texts, ascending: spaces go before the word they precede; spaces at the end are one token."""

    def last_of_word(here: np.ndarray, more: np.ndarray) -> np.ndarray:
        space = IS_SPACE[more]
        after = np.ones(len(here), dtype=bool)
        after[: len(more) - 1] = space[1 : len(here) + 1]
        return ~space[: len(here)] & after

    ends = places(data, last_of_word, 1) + 1
    closing = end[end > begin]  # a text ends its last token, whatever follows in the array
    inside = np.zeros(0, dtype=np.int64) if not len(closing) else ends
    return np.union1d(inside, closing)


def marked(data: np.ndarray) -> np.ndarray:
    """Where a mark begins."""
    letters = np.isin(np.arange(256), [m[1] for m in MARKS.values()])

    def begins(here: np.ndarray, more: np.ndarray) -> np.ndarray:
        n = min(len(here), len(more) - 2)
        found = np.zeros(len(here), dtype=bool)
        if n > 0:
            found[:n] = (more[:n] == 0x3C) & letters[more[1 : n + 1]] & (more[2 : n + 2] == 0x3E)
        return found

    return places(data, begins, 2)


def shifted(
    data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, total: int, *, back: bool = False
) -> np.ndarray:
    """Scatter: byte i goes to i + shift, into ``total`` bytes. With ``back`` gather: byte i comes from i + shift.

    ``shifts[k]`` holds from ``starts[k]`` (ascending) to the next start, in the bytes that are
    walked along: those of ``data``, or with ``back`` those of the result.
    """
    out = np.empty(total, dtype=np.uint8)
    change = np.diff(shifts, prepend=0)
    carry = 0
    for i, j in steps(total if back else len(data)):
        first, after = np.searchsorted(starts, [i, j])
        difference = np.zeros(j - i, dtype=np.int64)
        np.add.at(difference, starts[first:after] - i, change[first:after])  # empty parts share a start
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        at = shift + np.arange(i, j)
        if back:
            out[i:j] = data[at]
        else:
            out[at] = data[i:j]
    return out


def characters(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[int]:
    """Code points of each stretch of bytes."""
    return [int(np.count_nonzero((data[b:e] & 0xC0) != 0x80)) for b, e in zip(begin.tolist(), end.tolist())]


def _spread(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def cut_and_scatter(texts: Flat, draws: np.ndarray, rate: int, spm_share: int) -> dict[str, pa.Array]:
    """The output of every text. ``draws`` has four unsigned numbers for each."""
    base = int(texts.begin[0])
    data = texts.data[base : int(texts.end[-1])]
    begin, end = texts.begin - base, texts.end - base
    ends = token_ends(data, begin, end)
    first = np.searchsorted(ends, begin, side="right")  # tokens that end before the text
    n = np.searchsorted(ends, end, side="right") - first

    holds = np.zeros(len(begin), dtype=bool)
    at = marked(data)
    owner = np.searchsorted(begin, at, side="right") - 1
    holds[owner[at + MARK <= end[owner]]] = True
    plain = (n == 0) | holds | (draws[:, 2] % 100 >= rate)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm_share, 2, 1))

    units = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    bounds = np.concatenate([[0], ends])
    cuts = [np.where(units[:, c] == 0, begin, bounds[np.where(units[:, c] == 0, 0, first + units[:, c])]) for c in (0, 1)]
    borders = dict(zip(PARTS, [(begin, cuts[0]), (cuts[0], cuts[1]), (cuts[1], end)]))

    length = {p: e - b for p, (b, e) in borders.items()}
    out = _spread(np.where(plain, end - begin, end - begin + 3 * MARK))
    target = {p: b + out[:-1] - begin for p, (b, _) in borders.items()}  # as a plain text has them
    marks: list[tuple[np.ndarray, str]] = []
    for code, name in enumerate(FORMS[1:], 1):
        own, place = form == code, out[:-1].copy()
        for part in ORDERS[name]:
            marks.append((place[own], part))
            target[part] = np.where(own, place + MARK, target[part])
            place = place + MARK + length[part]
    starts = np.stack([borders[p][0] for p in PARTS], axis=1).ravel()
    shift = np.stack([target[p] - borders[p][0] for p in PARTS], axis=1).ravel()
    # a part without bytes has no say over those that follow at the same place
    filled = np.stack([length[p] > 0 for p in PARTS], axis=1).ravel()
    written = shifted(data, starts[filled], shift[filled], int(out[-1]))
    for place, part in marks:
        for k, byte in enumerate(MARKS[part]):
            written[place + k] = byte
    chars = {}
    for part in ("prefix", "middle"):
        b, e = borders[part]
        chars[part] = pa.array(characters(data, b, np.where(plain, b, e)), type=pa.int64(), mask=plain)
    return {
        "n": pa.array(n, type=pa.int64()),
        "form": pa.array([FORMS[f] for f in form], type=pa.string()),
        "prefix_chars": chars["prefix"],
        "middle_chars": chars["middle"],
        "output": column_of(written, out),
    }


def gather(outputs: Flat, form: np.ndarray) -> pa.Array:
    """The texts that the outputs were made of, from the outputs and their forms alone."""
    base = int(outputs.begin[0]) if len(outputs.begin) else 0
    data = outputs.data[base : int(outputs.end[-1])]
    begin, end = outputs.begin - base, outputs.end - base
    split = form > 0
    at = marked(data)
    owner = np.searchsorted(begin, at, side="right") - 1
    inside = split[owner] & (at + MARK <= end[owner])
    at, owner = at[inside], owner[inside]
    if not np.array_equal(owner, np.repeat(np.flatnonzero(split), 3)):
        raise ValueError("an output does not hold exactly three marks")
    at = at.reshape(-1, 3)
    # three parts in the order of the output, then sorted into that of the text
    b, e = at + MARK, np.concatenate([at[:, 1:], end[split][:, None]], axis=1)
    place = np.array([[ORDERS[f].index(p) for p in PARTS] if f in ORDERS else [0, 1, 2] for f in FORMS])[form[split]]
    b, e = np.take_along_axis(b, place, axis=1), np.take_along_axis(e, place, axis=1)
    out = _spread(np.where(split, end - begin - 3 * MARK, end - begin))
    source = np.stack([begin, end, end], axis=1)
    length = np.stack([end - begin, np.zeros_like(end), np.zeros_like(end)], axis=1)
    source[split], length[split] = b, e - b
    starts = out[:-1, None] + np.cumsum(length, axis=1) - length
    filled = (length > 0).ravel()
    shift = (source - starts).ravel()
    return column_of(shifted(data, starts.ravel()[filled], shift[filled], int(out[-1]), back=True), out)


def _portions(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded bytes; a long text stands alone."""
    if batch.num_rows:
        values = flat(batch.column(column))
        for part in portions((values.end - values.begin).tolist(), BYTES_AT_ONCE):
            yield batch.slice(part.start, part.stop - part.start)


def transform(
    docs: DataFrame, *, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row; other columns are left out.

    ``n`` counts tokens: a word with the spaces before it, or the spaces at the end. Cuts and form
    come from the SHA-256 of the seed and the id, so reruns agree and rows that share an id are cut
    at the same draws. A null id draws as if it were empty text; a null text is empty, and empty
    texts, texts that hold a mark and ``100 - rate`` percent of the others stay plain. A text of any
    length is one piece; only shifts of ``STEP`` bytes are held beside it and its output.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *[d.alias(f"h{k}") for k, d in enumerate(draws)])
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in _portions(batch, "text"):
                numbers = np.stack([own.column(f"h{k}").to_numpy() for k in range(4)], axis=1)
                made = cut_and_scatter(flat(own.column("text")), numbers, rate, spm_share)
                yield pa.RecordBatch.from_arrays([own.column("id"), *made.values()], names=["id", *made])

    made = rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", doc_id)


def restored(outputs: DataFrame) -> DataFrame:
    """The rows of ``transform`` with a column ``restored``, made from ``output`` and ``form`` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in _portions(batch, "output"):
                form = np.array([FORMS.index(f) for f in own.column("form").to_pylist()], dtype=np.int64)
                text = gather(flat(own.column("output")), form)
                yield pa.RecordBatch.from_arrays([*own.columns, text], names=[*own.schema.names, "restored"])

    return outputs.mapInArrow(run, f"{', '.join(f'`{c}` {t}' for c, t in outputs.dtypes)}, restored string")


def digests(docs: DataFrame, **parameters: int) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the SHA-256 of output and restored text."""
    both = restored(transform(docs, **parameters))
    hashed: dict[str, Column] = {f"{c}_sha256": F.sha2(F.col(c).cast("binary"), 256) for c in ("output", "restored")}
    return both.withColumns(hashed).drop("output", "restored")
