"""The anchored-TTL fold over sorted rows: vectorised numpy over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _codes(column: pa.Array) -> np.ndarray:
    """Runs of equal keys as increasing numbers. NULL is a key like any other, as
    in Spark's grouping, and so is NaN; no value is converted."""
    n = len(column)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    a, b = column.slice(1), column.slice(0, n - 1)
    both = pc.and_(pc.is_null(a, nan_is_null=True), pc.is_null(b, nan_is_null=True))
    differ = pc.fill_null(pc.not_equal(a, b), True)
    return np.concatenate(([0], np.cumsum(pc.and_not(differ, both).to_numpy(zero_copy_only=False))))


def _to_us(column: pa.Array) -> np.ndarray:
    """Microseconds of a timestamp column; a column of numbers holds them already."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    unit = pa.timestamp("us", tz=column.type.tz)
    return column.cast(unit).cast(pa.int64()).to_numpy(zero_copy_only=False)


def next_candidates(ecode: np.ndarray, et: np.ndarray, ttl_us: int) -> np.ndarray:
    """For eligible rows sorted by (key, time): the place of the first one of the
    same key at least a TTL later, or -1."""
    if not len(et):
        return np.zeros(0, dtype=np.int64)
    base = et.min()
    span = int(et.max() - base) + ttl_us + 1
    if span * (int(ecode[-1]) + 1) < 2**62:
        comp = ecode.astype(np.int64) * span + (et - base)
        nxt = np.searchsorted(comp, comp + ttl_us, side="left")
    else:  # very wide partitions: per key
        nxt = np.empty(len(et), dtype=np.int64)
        starts = np.flatnonzero(np.r_[True, ecode[1:] != ecode[:-1]])
        ends = np.r_[starts[1:], len(et)]
        for a, b in zip(starts, ends):
            nxt[a:b] = a + np.searchsorted(et[a:b], et[a:b] + ttl_us, side="left")
    valid = nxt < len(et)
    same = np.zeros(len(et), dtype=bool)
    same[valid] = ecode[nxt[valid]] == ecode[valid]
    return np.where(same, nxt, -1)


def fold_sorted(keys: np.ndarray, t: np.ndarray, elig: np.ndarray, ttl_us: int,
                carry: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Anchored-TTL fold over rows sorted by (key, t, tiebreak), all keys at once.

    Vectorised per call: one ``searchsorted`` gives every row's next-anchor
    candidate (restricted to its own key), then the chains of all keys are
    walked together; the loop runs once per anchor *rank*, i.e. at most
    span/ttl + 1 times, whatever the number of keys or rows. ``carry`` gives the
    time of the last anchor before these rows, by the key's number in them.
    """
    n = len(t)
    accepted = np.zeros(n, dtype=bool)
    if n == 0:
        return accepted, accepted.copy()
    codes = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1])))
    epos = np.flatnonzero(elig)
    ecode, et = codes[epos], t[epos]
    nxt = next_candidates(ecode, et, ttl_us)
    cur = np.flatnonzero(np.r_[True, ecode[1:] != ecode[:-1]]) if len(epos) else epos  # first eligible row per key
    for code, last in (carry or {}).items():
        a, b = np.searchsorted(ecode, [code, code + 1])
        i = a + np.searchsorted(et[a:b], last + ttl_us, side="left")
        cur = np.r_[cur[ecode[cur] != code], [i] if i < b else []].astype(np.int64)
    while cur.size:
        accepted[epos[cur]] = True
        cur = nxt[cur]
        cur = cur[cur >= 0]
    anchors = np.flatnonzero(accepted)
    j = np.searchsorted(anchors, np.arange(n), side="left") - 1
    has = j >= 0
    aj = anchors[np.maximum(j, 0)] if len(anchors) else np.zeros(n, dtype=np.int64)
    has &= codes[aj] == codes
    duplicate = ~accepted & has & (t < t[aj] + ttl_us)
    for code, last in (carry or {}).items():
        duplicate |= ~accepted & ~has & (codes == code) & (t < last + ttl_us)
    return accepted, duplicate


def _fold_partitions(key: str, ts: str, eligible: str, ttl_us: int, carry: dict | None = None, part: str | None = None):
    """mapInArrow body: partitions hold whole keys sorted by (key, ts, tiebreak).

    Arrow batches may split a key: the open key's rows are kept as a list of
    parts and concatenated once when the key closes (no quadratic copying).
    Only key, time and eligibility are looked at; the other columns, NULLs and
    large integers included, pass through as they are. ``carry`` maps (value of
    column ``part``, key) to the time of the last anchor before the partition.
    """
    known = carry or {}

    def run(batches):
        open_parts: list[pa.RecordBatch] = []  # rows of the key still open
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index(key)
            codes = _codes(batch.column(at))
            if open_parts:
                tail = open_parts[-1].column(at)
                meets = _codes(pa.concat_arrays([tail.slice(len(tail) - 1), batch.column(at).slice(0, 1)]))
                i = int(np.searchsorted(codes, 1)) if meets[1] == 0 else 0  # rows of the open key
                if i:
                    open_parts.append(batch.slice(0, i))
                if i == batch.num_rows:
                    continue
                yield from _finish(open_parts, key, ts, eligible, ttl_us, known, part)
                open_parts, batch, codes = [], batch.slice(i), codes[i:]
            j = int(np.searchsorted(codes, codes[-1]))  # first row of the last key
            if j:
                yield from _finish([batch.slice(0, j)], key, ts, eligible, ttl_us, known, part)
            open_parts = [batch.slice(j)]
        if open_parts:
            yield from _finish(open_parts, key, ts, eligible, ttl_us, known, part)

    return run


def _finish(parts: list[pa.RecordBatch], key: str, ts: str, eligible: str, ttl_us: int, carry: dict, part: str | None):
    """The parts with their ``accepted`` and ``duplicate`` columns."""
    table = pa.Table.from_batches(parts)
    column = lambda name: table.column(name).combine_chunks()
    elig = column(eligible).to_numpy(zero_copy_only=False).astype(bool)
    keys = column(key)
    codes = _codes(keys)
    entry = {}
    if carry:
        of = column(part)[0].as_py()
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        entry = {k: carry[of, v] for k, v in enumerate(keys.take(pa.array(starts)).to_pylist()) if (of, v) in carry}
    acc, dup = fold_sorted(codes, _to_us(column(ts)), elig, ttl_us, entry)
    at = 0
    for rows in parts:
        end = at + rows.num_rows
        flags = [pa.array(acc[at:end]), pa.array(dup[at:end])]
        yield pa.RecordBatch.from_arrays(rows.columns + flags, names=rows.schema.names + ["accepted", "duplicate"])
        at = end
