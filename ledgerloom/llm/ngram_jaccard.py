"""N-gram Jaccard self-join by T-occurrence search, with components of the links.

1. Every text becomes its set of hashed word shingles. Texts with equal sets form a class.
2. Blocking that loses no link: a set of n shingles is cut by hash into k parts, k being more
   than the largest symmetric difference that two linked sets of its size range can have, by so
   much that linked sets agree on a number of whole parts (pigeonhole). A part's hash is its
   signature. Pairs that share enough signatures are led together, see `block_leads`, first inside
   each batch, so that a signature reaches the shuffle once per batch however many near copies
   share it. The components of these leads hold every component of the true links.
3. Inside each of them runs the T-occurrence search: an inverted index of the group's sets; for
   a set the inverted lists are ordered by length, DivideSkip leaves L long ones aside, the
   short ones are merged with a heap, and every set met at least T - L times is probed in the
   long lists by binary search. Those that reach the required overlap are linked. Sets already
   known to be connected are not probed again.
4. Large groups are searched in blocks: every block together with the first one, then the sets
   not connected to the main component against all blocks of sets of like size, by pairs of blocks.

Shingles are compared by 64-bit hashes.

A null text, one without words, has the empty set and no links; an empty table gives an empty result. Very
long texts have large sets, which are compared whole. Columns other than id and text are ignored, whatever
their names. Rows of one id are one document:
they count as connected, so repeated rows change nothing. Rows with a null id are linked with
nothing and their component is null.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, mix64, scan_words, slices, staged, table, text_buffer, word_table
from ledgerloom.llm.components import components, stars

WORDS = 3
PERCENT = 90
GROUP = 512
BLOCK = 256
WIDE_BLOCK = 1024  # of sets outside the main component against all: wide ones send a text to few places, narrow ones spread the search
SKIP_COST = 0.01

VALUES = word_table(bytes([0x20, *range(0x09, 0x0E)]))
_FACTORS = [np.uint64(x | 1) for x in mix64(np.arange(100, 164, dtype=np.uint64)).tolist()]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles; a shorter text is one shingle."""
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        _, words, counts = scan_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], VALUES)
        whole = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            whole += words[k:k + len(whole)] * _FACTORS[k]
        whole = mix64(whole)
        first = 0
        for n in counts.tolist():
            if n >= width:
                own = np.sort(whole[first:first + n - width + 1])
                yield own[np.r_[True, own[1:] != own[:-1]]]
            elif n:
                yield mix64((words[first:first + n] * np.array(_FACTORS[:n])).sum(keepdims=True, dtype=np.uint64) + _FACTORS[10 + n])
            else:
                yield np.zeros(0, np.uint64)
            first += n


class Overlap:
    """What a Jaccard similarity of at least percent / 100 asks of set sizes."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [0]  # largest size of each size range; linked sets are at most one range apart

    def needed(self, a: int, b: int) -> int:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def least(self, a: int) -> int:
        """Least intersection with any linked set."""
        return -(-self.percent * a // 100)

    def range_of(self, n: int) -> int:
        while self.bounds[-1] < n:
            low = self.bounds[-1] + 1
            self.bounds.append(max(low, low * 100 // self.percent))
        return int(np.searchsorted(self.bounds, n))

    def parts(self, r: int) -> tuple[int, int, int]:
        """Parts for pairs whose larger set is in range r, how many of them may be left out, and on how many of the others linked sets agree."""
        while r >= len(self.bounds):
            self.range_of(self.bounds[-1] + 1)
        differ = 2 * self.bounds[r] * (100 - self.percent) // (100 + self.percent)
        spare = 0 if differ < 3 else max(1, differ // 4)
        return differ + 1 + 2 * spare, spare, spare + 1

    def agreed(self, steps: np.ndarray) -> np.ndarray:
        """The last of `parts` of many ranges."""
        known, back = np.unique(steps, return_inverse=True)
        return np.array([self.parts(r)[2] for r in known.tolist()], np.int64)[back]


def signatures(own: np.ndarray, overlap: Overlap) -> np.ndarray:
    """Part hashes of a set, without those of its `spare` smallest parts, which unlike sets may share.

    Linked sets agree on 2 * spare + 1 parts at least. Parts are ordered by size and hash, which are the same
    in both sets for a part that they share, so of the parts that they share, all but the first `spare` stand
    behind `spare` others in both and are left out of neither. A hash ends in a bit for the range it is made for.
    """
    out = []
    r = overlap.range_of(len(own))
    for step in (r, r + 1):
        k, spare, _ = overlap.parts(step)
        part = (own % np.uint64(k)).astype(np.int64)
        low = np.bincount(part, (own >> np.uint64(8) & np.uint64(0xFFFFFFFF)).astype(np.float64), k)
        high = np.bincount(part, (own >> np.uint64(32)).astype(np.float64), k)
        size = np.bincount(part, minlength=k)
        name = mix64(low.astype(np.uint64) * _FACTORS[0] + high.astype(np.uint64) * _FACTORS[1]
                     + size.astype(np.uint64) * _FACTORS[2] + np.arange(k, dtype=np.uint64) * _FACTORS[3]
                     + np.full(k, step, np.uint64) * _FACTORS[4])
        name = name & ~np.uint64(1) | np.uint64(step & 1)
        out.append(name[np.lexsort((name, size))[spare:]])
    return np.concatenate(out)


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set."""
    scaled = own * np.arange(1, 2 * len(own), 2, dtype=np.uint64)
    pair = np.array([scaled.sum(dtype=np.uint64), mix64(own + _FACTORS[5]).sum(dtype=np.uint64)], np.uint64)
    return tuple(mix64(pair).view(np.int64).tolist())


def set_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, f1, f2): set size and fingerprint of every row."""

    def run(batches):
        for batch in batches:
            rows = [(len(own), *fingerprint(own)) for own in shingle_sets(batch.column(1), width)]
            n, f1, f2 = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64())],
                names=["id", "n", "f1", "f2"])

    return _source(docs, id_col, text_col).mapInArrow(lean(run), "id long, n long, f1 long, f2 long")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


NAME = 5  # bytes of a signature that are sent; unlike ones that look alike only add leads
FEW = 8  # sets of a signature that meet pair by pair
SIGNED = "slot int, names binary, places binary, ids binary, ranges binary, followers binary, leaders binary"
MET = "slot int, a binary, b binary, steps binary, times binary, owners binary, names binary, ranges binary"
LED = "slot int, names binary, ids binary, followers binary, leaders binary"


def _lead(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal names the smallest id leads: (follower, leader) stars."""
    order = np.lexsort((ids, names))
    names, ids = names[order], ids[order]
    first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
    leader = np.repeat(ids[first], np.diff(np.r_[first, len(ids)]))
    other = ids != leader
    return stars(ids[other], leader[other])


def _tally(*columns: np.ndarray, times: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct rows of these columns, and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(fresh)
    times = np.ones(len(order), np.int64) if times is None else times[order]
    return [*(c[first] for c in columns), np.add.reduceat(times, first) if len(first) else np.zeros(0, np.int64)]


def _step(names: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """The range that a signature is made for, by its last bit: its set's or the next one."""
    return ranges + (ranges + names.astype(np.int64) & 1)


def _of(ids: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """One hash for an id and a range."""
    return mix64(mix64(ids.view(np.uint64)) + steps.view(np.uint64) * _FACTORS[0])


def _together(names: np.ndarray, place: np.ndarray, ranges: np.ndarray, ids: np.ndarray, overlap: Overlap) -> np.ndarray:
    """Per set of a batch, the set that stands for it: sets agreeing on as many signatures as linked ones do stand together."""
    order = np.lexsort((ids[place], names))
    names, place = names[order], place[order]
    first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    leader = np.repeat(place[first], np.diff(np.r_[first, len(names)]))
    other = place != leader
    a, b, steps, times = _tally(place[other], leader[other], _step(names[other], ranges[place[other]]))
    enough = times >= overlap.agreed(steps)
    followers, leaders = stars(a[enough], b[enough])
    root = np.arange(len(ids))
    root[followers] = leaders
    return root


def _dealt(slots: int, slot: np.ndarray, *columns: np.ndarray) -> list[list[bytes]]:
    """Per slot, the bytes of the rows dealt to it."""
    order = np.argsort(slot, kind="stable")
    cuts = np.searchsorted(slot[order], np.arange(slots + 1)).tolist()
    columns = [c[order] for c in columns]
    return [[c[a:b].tobytes() for c in columns] for a, b in zip(cuts[:-1], cuts[1:])]


def _packed(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of a slot and binaries."""
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32() if k == 0 else pa.binary()) for k in range(len(names))], names=names)


def _gathered(batches, types: tuple) -> list[np.ndarray]:
    """All rows' binaries after the slot, as one array a column."""
    parts = [[np.frombuffer(v, t) for v in batch.column(k + 1).to_pylist()] for batch in batches for k, t in enumerate(types)]
    return [np.concatenate([np.zeros(0, t), *(x for p in parts[k::len(types)] for x in p)]) for k, t in enumerate(types)]


def block_leads(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, few: int = FEW) -> DataFrame:
    """(a, b): links that hold every component of the true ones together, by signatures that sets share.

    Linked sets share some number of signatures of one range, say c, or more. Signatures of `few` sets or less give pairs,
    and a pair's are counted. How many signatures of more sets a pair shares is not known, but no more than its larger id
    has, say f; so a pair is left out if it is counted less than c - f times. A linked pair that is never counted
    shares c signatures of more sets: sets that have so many are led to the smallest such set of each of them, others are not.
    So a passage that unlike sets share, however frequent, joins none of them into a group.

    A batch sends its signatures by slot, `NAME` bytes each, with a 16-bit place in a list of their owners.
    """
    spark = docs.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = np.uint64((1 << 8 * NAME) - 1)

    def emit(batches):
        overlap = Overlap(percent)
        for batch in batches:
            names, ids, ranges, equal, copies = [], [], [], {}, []
            for own, key in zip(shingle_sets(batch.column(1), width), batch.column(0).to_pylist()):
                if len(own) and key is not None:
                    at = equal.setdefault(fingerprint(own), len(ids))
                    if at < len(ids):
                        copies.append((key, at))
                        continue
                    names.append(signatures(own, overlap))
                    ids.append(key)
                    ranges.append(overlap.range_of(len(own)))
            if not names:
                continue
            ids, ranges = np.array(ids, np.int64), np.array(ranges, np.int64)
            place = np.repeat(np.arange(len(ids)), [len(x) for x in names])
            names = np.concatenate(names)
            root = ids[_together(names, place, ranges, ids, overlap)]
            led = np.array(copies, np.int64).reshape(-1, 2)
            a, b = np.r_[led[:, 0], ids], np.r_[root[led[:, 1]], root]
            followers, leaders = a[a != b], b[a != b]
            slot = (names >> np.uint64(8 * NAME)) % np.uint64(slots)
            order = np.lexsort((root[place], names, slot))
            slot, names, place = slot[order], names[order], place[order]
            once = np.r_[True, (names[1:] != names[:-1]) | (root[place[1:]] != root[place[:-1]])]
            slot, names, place = slot[once], names[once] & low, place[once]
            cuts = np.searchsorted(slot, np.arange(slots + 1)).tolist()
            share = np.array_split(np.arange(len(followers)), slots)
            rows = []
            for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                for c in range(a, max(b, a + 1), 1 << 16):  # places fit 16 bits
                    d = min(b, c + (1 << 16))
                    own, at = np.unique(place[c:d], return_inverse=True)
                    led = share[s] if c == a else share[s][:0]
                    if d > c or len(led):
                        rows.append((s, names[c:d].view(np.uint8).reshape(-1, 8)[:, :NAME].tobytes(), at.astype(np.uint16).tobytes(),
                                     root[own].tobytes(), ranges[own].astype(np.int16).tobytes(), followers[led].tobytes(), leaders[led].tobytes()))
            yield _packed(rows, SIGNED)

    def meet(batches):
        gathered: dict[int, list] = {}
        pairs = []
        for batch in batches:
            for slot, names, places, ids, ranges, followers, leaders in zip(*(c.to_pylist() for c in batch.columns)):
                wide = np.zeros((len(places) // 2, 8), np.uint8)
                wide[:, :NAME] = np.frombuffer(names, np.uint8).reshape(-1, NAME)
                at = np.frombuffer(places, np.uint16)
                gathered.setdefault(slot, []).append((wide.reshape(-1).view(np.uint64), np.frombuffer(ids, np.int64)[at],
                                                      np.frombuffer(ranges, np.int16)[at].astype(np.int64)))
                pairs.append((np.frombuffer(followers, np.int64), np.frombuffer(leaders, np.int64)))
        for slot in list(gathered):
            parts = gathered.pop(slot)
            names, ids, ranges = (np.concatenate([p[k] for p in parts]) for k in range(3))
            names, ids, steps, _ = _tally(names, ids, _step(names, ranges))
            first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
            many = np.diff(np.r_[first, len(names)])
            a, b, at = [], [], []
            for m in range(2, few + 1):
                start = first[many == m]
                for i, j in combinations(range(m), 2):  # ids ascend
                    a.append(start + j)
                    b.append(start + i)
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
            apart = ids[a] != ids[b]
            a, b, steps_met, times = _tally(ids[a[apart]], ids[b[apart]], steps[a[apart]])
            more = np.repeat(many > few, many)
            yield _sent(a, b, steps_met, times, ids[more], names[more] | np.uint64(slot) << np.uint64(8 * NAME), steps[more])
        if pairs:
            followers, leaders = stars(*(np.concatenate([p[i] for p in pairs]) for i in range(2)))
            none = np.zeros(0, np.int64)
            yield _sent(followers, leaders, np.full(len(followers), -1), np.ones(len(followers), np.int64), none, none.astype(np.uint64), none)

    def _sent(a, b, steps, times, owners, names, ranges):
        """Rows for the larger id's slot; pairs known to belong together are of range -1."""
        pairs = _dealt(slots, mix64(a.view(np.uint64)) % np.uint64(slots), a, b, steps.astype(np.int16), times.astype(np.int32))
        own = _dealt(slots, mix64(owners.view(np.uint64)) % np.uint64(slots), owners, names, ranges.astype(np.int16))
        return _packed([(s, *x, *y) for s, (x, y) in enumerate(zip(pairs, own)) if x[0] or y[0]], MET)

    def sift(batches):
        overlap = Overlap(percent)
        a, b, steps, times, owners, names, ranges = _gathered(batches, (np.int64, np.int64, np.int16, np.int32, np.int64, np.uint64, np.int16))
        a, b, steps, times = _tally(a, b, steps.astype(np.int64), times=times.astype(np.int64))
        ranges = ranges.astype(np.int64)
        own = _of(owners, ranges)
        which, back, often = np.unique(own, return_inverse=True, return_counts=True)
        apart = steps >= 0
        at, many = _of(a, steps), np.zeros(len(a), np.int64)
        if len(which):
            place = np.minimum(np.searchsorted(which, at), len(which) - 1)
            many = np.where(which[place] == at, often[place], 0)
        keep = np.ones(len(a), bool)
        keep[apart] = times[apart] >= overlap.agreed(steps[apart]) - many[apart]
        followers, leaders = stars(a[keep], b[keep])
        stay = often[back] >= overlap.agreed(ranges)
        owners, names = owners[stay], names[stay]
        sent = _dealt(slots, mix64(names) % np.uint64(slots), names, owners)
        links = _dealt(slots, np.arange(len(followers)) % slots, followers, leaders)
        yield _packed([(s, *x, *y) for s, (x, y) in enumerate(zip(sent, links)) if x[0] or y[0]], LED)

    def close(batches):
        names, ids, followers, leaders = _gathered(batches, (np.uint64, np.int64, np.int64, np.int64))
        a, b = _lead(names, ids)
        followers, leaders = stars(np.r_[a, followers], np.r_[b, leaders])
        yield pa.RecordBatch.from_arrays([pa.array(followers), pa.array(leaders)], names=["a", "b"])

    signed = _source(docs, id_col, text_col).mapInArrow(lean(emit), SIGNED)
    met = signed.repartition(slots, "slot").mapInArrow(lean(meet), MET)
    led = met.repartition(slots, "slot").mapInArrow(lean(sift), LED)
    return led.repartition(slots, "slot").mapInArrow(lean(close), "a long, b long")


class Search:
    """T-occurrence search with DivideSkip over the sets of one group."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], overlap: Overlap, known: list[int] | None = None):
        self.ids, self.sets, self.overlap = ids, sets, overlap
        self.parent = list(range(len(ids)))
        if known is not None:  # sets that are connected already
            seen: dict[int, int] = {}
            for i, name in enumerate(known):
                self.parent[i] = seen.setdefault(name, i)
        hashes = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        self.lengths = np.diff(np.r_[first, len(hashes)])
        self.firsts, self.postings = first, owner
        number = np.repeat(np.arange(len(first)), self.lengths)
        self.keys = number * len(sets) + owner  # one sorted key per posting: list, then set
        back = np.lexsort((number, owner))
        self.lists = np.split(number[back], np.cumsum([len(s) for s in sets])[:-1])

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def candidates(self, x: int, limit: int) -> tuple[Iterator[tuple[int, int]], np.ndarray]:
        """Sets below `limit` met often enough in the short lists, with their count; the long lists."""
        lists = self.lists[x]
        need = self.overlap.least(len(lists))
        order = lists[np.argsort(self.lengths[lists], kind="stable")]
        longest = max(2, int(self.lengths[order[-1]]))
        aside = min(need - 1, int(need / (SKIP_COST * math.log2(longest) + 1)))
        short, long = order[:len(order) - aside], order[len(order) - aside:]
        short = short[self.lengths[short] > 1]  # a list of one holds only x

        def merge():
            runs = []
            for k in short.tolist():
                run = self.postings[self.firsts[k]:self.firsts[k] + self.lengths[k]]
                runs.append(run[:np.searchsorted(run, limit)].tolist())
            for y, met in groupby(heapq.merge(*(r for r in runs if r))):
                count = sum(1 for _ in met)
                if count >= need - aside:
                    yield y, count

        return merge() if len(short) >= need - aside else iter(()), long

    def run(self, turn: range | None = None) -> Iterator[tuple[int, int]]:
        """Links that connect the sets; `turn` are the sets to search for, against all before them."""
        for x in turn or range(1, len(self.sets)):
            found, long = self.candidates(x, x)
            for y, count in found:
                root, own = self.find(y), self.find(x)
                if root == own:
                    continue
                need = self.overlap.needed(len(self.sets[x]), len(self.sets[y]))
                if need > min(len(self.sets[x]), len(self.sets[y])):
                    continue
                want = long * len(self.sets) + y
                at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                if count + int((self.keys[at] == want).sum()) >= need:
                    self.parent[max(root, own)] = min(root, own)
                    yield self.ids[x], self.ids[y]


def _search_groups(groups: DataFrame, width: int, percent: int) -> DataFrame:
    """Links inside each group of (key, id, side, known, text) rows, `side` 1 being searched for, 0 also among themselves."""

    def run(batches):
        overlap = Overlap(percent)

        def rows():
            for batch in batches:
                for values in zip(*(batch.column(k).to_pylist() for k in ("key", "id", "side", "known")),
                                  shingle_sets(batch.column("text"), width)):
                    yield values

        out_a, out_b = [], []
        for _, members in groupby(rows(), key=lambda r: r[0]):
            members = sorted(members, key=lambda r: (r[2], r[1]))
            known = [r[3] for r in members]
            turn = None
            if members[0][2] == 0 and members[-1][2] == 1:
                turn = range(sum(r[2] == 0 for r in members), len(members))
            for a, b in Search([r[1] for r in members], [r[4] for r in members], overlap, known).run(turn):
                out_a.append(a)
                out_b.append(b)
            if len(out_a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])
                out_a, out_b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    keyed = groups.select("key", "id", F.col("side").cast("int").alias("side"), F.col("known").cast("long").alias("known"), "text")
    tasks = max(1, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # fixed: searching costs more than reading
    return keyed.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(lean(run), "a long, b long")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS,
                    percent: int = PERCENT, group: int = GROUP, block: int = BLOCK, wide: int = WIDE_BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    Two rows are linked when the Jaccard similarity of their shingle sets is at least
    percent / 100; the component is the smallest id reachable by links, itself included.
    """
    sets = staged(set_table(docs, id_col, text_col, width), "sets")
    groups = components(block_leads(docs, id_col, text_col, width, percent), contracted=True).select(F.col("node").alias("id"), F.col("component").alias("grp"))
    # one member of each class of equal sets, by its smallest id; a class lies inside one group
    named = sets.where("n > 0 AND id IS NOT NULL").select("id", "f1", "f2").distinct()
    classes = named.groupBy("f1", "f2").agg(F.min("id").alias("id"))
    members = staged(classes.select("id").distinct().join(groups, "id"), "members")
    sizes = members.groupBy("grp").agg(F.count("*").alias("m")).where("m > 1")
    members = staged(members.select("id", "grp").join(sizes, "grp").withColumn(
        "blocks", F.when(F.col("m") <= group, 1).otherwise(F.ceil(F.col("m") / block)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), "members")
    texts = _source(docs, id_col, text_col)
    wanted = members.join(texts, "id")
    repeated = sets.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    repeats = bool(repeated.limit(1).count())
    if repeats:
        wanted = wanted.dropDuplicates(["id", "text"])
    wanted = staged(wanted, "texts")  # all texts are read once for the members' own
    hub = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = wanted.withColumn("turn", F.explode(hub)).select(
        F.concat_ws("/", "grp", "turn").alias("key"), "id", (F.col("block") > 0).cast("int").alias("side"),
        F.col("id").alias("known"), "text")
    links = staged(_search_groups(first, width, percent), "found")
    if repeats:
        links = staged(links.union(named.join(repeated, "id").join(
            classes.withColumnRenamed("id", "b"), ["f1", "f2"]).select(F.col("id").alias("a"), "b")), "found")
    links = _finish(links, members, sets.select("id", "n"), wanted, width, percent, wide)
    joined = components(links).select(F.col("node").alias("id"), "component")
    merged = classes.join(joined, "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("component"))
    return sets.join(merged, ["f1", "f2"], "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def _finish(links: DataFrame, members: DataFrame, counts: DataFrame, wanted: DataFrame, width: int, percent: int, block: int) -> DataFrame:
    """For groups searched in blocks: the sets outside the group's main component against all sets that their size lets them link with.

    The sets of a group are dealt to cells by the range of their size, counts(id, n), and a cell to wide blocks. A set outside the main
    component goes to the cell of its range and those beside it; sets of further ranges cannot be linked with it.
    """
    large = members.where("blocks > 1")
    if not large.limit(1).count():
        return links
    joined = components(links).select(F.col("node").alias("id"), "component")
    state = staged(large.select("id", "grp").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id")), "state")
    sizes = state.groupBy("grp", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("grp").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    counts = counts.join(state.select("id"), "id", "left_semi").select("id", "n").distinct()  # an id may have several sets
    overlap = Overlap(percent)
    overlap.range_of(int(counts.agg(F.max("n")).first()[0] or 0))
    below = F.size(F.filter(F.array(*map(F.lit, overlap.bounds)), lambda x: x < F.col("n")))
    held = staged(state.join(counts, "id").join(main, "grp").withColumn("cell", below).drop("n").distinct(), "cells")
    near = F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))
    left = held.where("component <> main").withColumn("cell", near).distinct()
    blocks = held.groupBy("grp", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    parts = left.groupBy("grp", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    grid = blocks.join(parts, ["grp", "cell"])
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64(F.lit(7), "id"), F.col("parts")).cast("int")
    texts = wanted.select("id", "text")
    fixed = held.join(grid, ["grp", "cell"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.concat_ws("/", "grp", "cell", own, "turn").alias("key"), "id", F.lit(0).alias("side"), F.col("component").alias("known"))
    asked = left.join(grid, ["grp", "cell"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws("/", "grp", "cell", "turn", part).alias("key"), "id", F.lit(1).alias("side"), F.col("component").alias("known"))
    more = _search_groups(fixed.union(asked).join(texts, "id"), width, percent)
    # what is known to be connected was skipped, so the earlier links stay beside the new ones
    return staged(links.union(more), "found")


def op9_ngram_jaccard(spark, folder: str) -> DataFrame:
    return link_components(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, greatest(0, len(w) - least(3, len(w)) + 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.c + nb.c - k)),
u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT doc_id AS node, doc_id AS seen FROM d
  UNION
  SELECT r.node, u.b FROM r JOIN u ON u.a = r.seen)
SELECT d.doc_id, coalesce(max(n.c), 0) AS n_shingles, min(r.seen) AS component_id
FROM d JOIN r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
