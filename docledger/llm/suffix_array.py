"""Suffix arrays by induced sorting, and permuted common prefixes, as array operations.

The suffixes of a text are classified into S (smaller than the next suffix) and L.  The leftmost S suffixes of each run
cut the text into substrings; these are sorted, several letters as one number at a time, and named.  If names repeat, the string
of names, at most half as long, is sorted in turn.  An induction pass over the sorted leftmost-S suffixes gives the array.

An induction pass goes through the buckets of first letters.  All members of a large bucket induce their predecessors at
once: the predecessors are dealt to their buckets by a stable sort on their letters, and a bucket's own members that induce
members of the same bucket are taken in waves, one for each step of a run of equal letters.  The members of a bucket of fewer
than ``BUCKET`` are taken one by one; a string of names has ever more of those.
"""

from __future__ import annotations

import numpy as np

#: Members from which on a bucket is handled as an array.
BUCKET = 64


def _types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes. The end of the text is smaller than any byte."""
    n = len(text)
    step = np.zeros(n, np.int8)  # 1: the next byte is larger, -1: smaller, 0: equal
    step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1]).astype(np.int8)
    step[-1] = -1
    at = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return step[nearest] > 0


def _deal(pred: np.ndarray, char: np.ndarray, out: np.ndarray, at: np.ndarray, sign: int) -> None:
    """Appends each of ``pred`` to the bucket of its letter, in order; ``at`` has the next free place of each bucket."""
    order = np.argsort(char, kind="stable")
    chars, pred = char[order], pred[order]
    heads = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
    size = np.diff(np.append(heads, len(chars)))
    rank = np.arange(len(pred)) - np.repeat(heads, size)
    out[at[chars] + sign * rank] = pred
    at[chars[heads]] += sign * size


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, letters: int) -> np.ndarray:
    """The array that the leftmost-S suffixes, in this order, induce."""
    n = len(text)
    size = np.bincount(text, minlength=letters)
    begin = np.concatenate([[0], np.cumsum(size)])
    head, tail = begin[:-1].copy(), begin[1:] - 1
    out = np.full(n, -1, np.int32)
    lms_char = text[lms]
    by_char = np.argsort(lms_char, kind="stable")
    lms_sorted, lms_begin = lms[by_char], np.concatenate([[0], np.cumsum(np.bincount(lms_char, minlength=letters))])
    # The same arrays for single items, which views read and write faster.
    text1, is_s1, out1, head1, tail1, lms1, lms_begin1 = (memoryview(x) for x in (text, is_s, out, head, tail, lms_sorted, lms_begin))

    def from_many(members: np.ndarray, want_s: bool, at: np.ndarray, sign: int) -> None:
        pred = members[members > 0] - 1
        pred = pred[is_s[pred] == want_s]
        if len(pred):
            _deal(pred, text[pred], out, at, sign)

    # L suffixes, bucket by bucket upwards. The end of the text induces the last suffix first.
    last = int(text[n - 1])
    out[head[last]] = n - 1
    head[last] += 1
    used = np.flatnonzero(size).tolist()
    for c in used:
        done = begin_c = int(begin[c])
        while done < head1[c]:
            upto = head1[c]
            if upto - done >= BUCKET:
                from_many(out[done:upto], False, head, 1)
                done = upto
                continue
            i = out1[done]
            done += 1
            if i > 0 and not is_s1[i - 1]:
                d = text1[i - 1]
                out1[head1[d]] = i - 1
                head1[d] += 1
        a, b = lms_begin1[c], lms_begin1[c + 1]
        if b - a >= BUCKET:
            from_many(lms_sorted[a:b], False, head, 1)
        else:
            for k in range(a, b):
                i = lms1[k]
                if i > 0 and not is_s1[i - 1]:
                    d = text1[i - 1]
                    out1[head1[d]] = i - 1
                    head1[d] += 1
    # S suffixes, bucket by bucket downwards; then the bucket's L suffixes.
    for c in reversed(used):
        done, begin_c, upto = int(begin[c + 1]) - 1, int(begin[c]), head1[c]
        while done > tail1[c]:
            low = tail1[c]
            if done - low >= BUCKET:
                from_many(out[low + 1 : done + 1][::-1], True, tail, -1)
                done = low
                continue
            i = out1[done]
            done -= 1
            if i > 0 and is_s1[i - 1]:
                d = text1[i - 1]
                out1[tail1[d]] = i - 1
                tail1[d] -= 1
        if upto - begin_c >= BUCKET:
            from_many(out[begin_c:upto][::-1], True, tail, -1)
        else:
            for k in range(upto - 1, begin_c - 1, -1):
                i = out1[k]
                if i > 0 and is_s1[i - 1]:
                    d = text1[i - 1]
                    out1[tail1[d]] = i - 1
                    tail1[d] -= 1
    return out


def _sort_substrings(text: np.ndarray, begin: np.ndarray, end: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the leftmost-S substrings, and for each in order whether it is another than the one before it.

    A substring that goes on where another ends is the smaller one, since the other ends with an S suffix and it does not.  The
    end of the text is smaller than any letter.
    """
    bits = (letters + 1).bit_length()
    width = 62 // bits
    m, n = len(begin), len(text)

    def key(which: np.ndarray, done: int) -> np.ndarray:
        out = np.zeros(len(which), np.int64)
        at, stop = begin[which] + np.int64(done), end[which]
        for _ in range(width):
            letter = text[np.minimum(at, n - 1)].astype(np.int64) + 1
            out = (out << bits) | np.where(at < stop, letter, np.where(stop == n, 0, letters + 1))
            at += 1
        return out

    size = end - begin
    first = key(np.arange(m), 0)
    order = np.argsort(first, kind="stable")
    new = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    done = width
    while True:
        # Runs of equal substrings of which the end has not been compared.
        heads = np.flatnonzero(new)
        run = np.diff(np.append(heads, m))
        open_ = np.flatnonzero(np.repeat(run > 1, run))
        open_ = open_[size[order[open_]] >= done]
        if not len(open_):
            return order, new
        group = np.cumsum(new)[open_]
        if done > 64 * width:  # a few very long ones
            items = sorted(zip(group.tolist(), ((text[begin[k] : end[k]].astype(">i4").tobytes() + (b"" if end[k] == n else b"\xff" * 4), k) for k in order[open_].tolist()), strict=True))
            order[open_] = [k for _, (_, k) in items]
            new[open_[1:]] |= np.array([x[1][0] != y[1][0] for x, y in zip(items, items[1:], strict=False)], bool)
            return order, new
        more = key(order[open_], done)
        by = np.lexsort((more, group))
        order[open_] = order[open_][by]
        more, group = more[by], group[by]
        new[open_[1:]] |= (more[1:] != more[:-1]) & (group[1:] == group[:-1])
        done += width


def _sorted_suffixes(text: np.ndarray, letters: int) -> np.ndarray:
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    is_s = _types(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + np.int32(1)
    if len(lms) > 1:
        order, new = _sort_substrings(text, lms, np.append(lms[1:] + 1, n), letters)
        name = np.cumsum(new) - 1
        if name[-1] + 1 < len(lms):
            names = np.empty(len(lms), np.int32)
            names[order] = name
            order = _sorted_suffixes(names, int(name[-1]) + 1)
        lms = lms[order]
    return _induce(text, is_s, lms, letters)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of a byte array in ascending order (int32; under 2**31 bytes)."""
    return _sorted_suffixes(text, 256)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, most: int, stride: int = 16) -> np.ndarray:
    """For each position, how long a prefix it shares with the suffix before it in the array, up to ``most``.

    The value at a position is at least the value at the position before it less one.  Every ``stride``-th position is
    compared from the start, the others from what that bound leaves; each step compares eight bytes of all open positions.
    """
    n = len(text)
    phi = np.full(n, -1, np.int32)
    phi[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(n, np.int32)
    for r in range(stride):
        i = np.arange(r, n, stride, dtype=np.int64)
        j = phi[i].astype(np.int64)
        got = np.maximum(out[i - 1] - 1, 0) if r else np.zeros(len(i), np.int32)
        got[j < 0] = 0
        open_ = np.flatnonzero((j >= 0) & (got < most))
        while len(open_):
            a, b = i[open_] + got[open_], j[open_] + got[open_]
            room = n - np.maximum(a, b)
            same = eight[np.minimum(a, n)] == eight[np.minimum(b, n)]
            run = np.where(same.all(axis=1), 8, same.argmin(axis=1))
            run = np.minimum(run, np.maximum(room, 0)).astype(np.int32)
            got[open_] += run
            open_ = open_[(run == 8) & (got[open_] < most)]
        out[i] = np.minimum(got, most)
    return out
