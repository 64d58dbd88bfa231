"""Spelling variants: words one edit apart, found in a trie of letter counts.

Letters are dealt into `GROUPS` groups of about equal frequency. A word's path in the trie is its length and then its
count of letters in each group, one level each. Words one edit apart have counts that differ by a surplus of one, a
deficit of one, or one of each, so a search goes down depth-first with a budget of one surplus and one deficit and
meets few leaves; the words of a leaf are verified letter by letter. Each pair is looked for from one side: the shorter
word looks among longer ones, spending a surplus only; of words of one length the surplus comes first on the way down,
and words with the same counts look for larger ones.

The top of the trie is laid out on Spark: every word is a member of one node and asks a few neighbouring nodes, with
what is left of its budget. A node with more rows than a task should have goes down one more level, members and askers
alike, until it is small; one that is still crowded at a leaf is matched by a join on the words without one letter.
Every other node is one task's trie, walked in blocks of askers of bounded size.

Words are runs of A-Z, a-z and U+00C0..U+00FF, with A-Z lower-cased, and are held as Latin-1 bytes, whose order is that
of code points. A null text has no words; a null key counts as an empty one; repeated rows count twice. An empty table
gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import texts
from tidewire.operators.joins import fits
from tidewire.session import cut_lineage

GROUPS = 14
# Levels below the length that all words are laid out by.
FIRST_LEVELS = 3
LEAST_LENGTH = 5
LEAST_COUNT = 3
# Every so manieth pair of document and run loses a letter (a fixed value).
SLIPS = 97
# A form has at least so many times the word's own count.
FORM_SHARE = 2

# What a task holds: words counted, a node's rows and bytes, askers and states walked at a time, letters compared at a time.
TASK_WORDS = 400_000
NODE_ROWS = 1 << 13
NODE_BYTES = 1 << 24
WALK = 1 << 13
STATES = 1 << 18
LETTERS = 1 << 24

MEMBER, SAME, LONGER = 0, 1, 2
STATE = "word binary, n bigint, path binary, mode tinyint, spent tinyint"

# Latin-1 bytes: A-Z to lower case, everything but letters to a space.
RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


# --- words --------------------------------------------------------------------------------------


def words_of(key, text: str, least: int = LEAST_LENGTH) -> Iterator[tuple[bytes, int]]:
    """The words of a document, with slips, and how often each occurs."""
    seed = zlib.crc32(f"{'' if key is None else key}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(RUNS).split()).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % SLIPS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        yield run, n


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least `least` occurrences, written."""

    def give(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for k, t in zip(batch.column(key).to_pylist(), texts(batch, text), strict=True):
                for word, n in words_of(k, t):
                    counts[word] += n
                if len(counts) > TASK_WORDS:
                    yield give(counts)
                    counts = Counter()
        if counts:
            yield give(counts)

    counted = docs.select(key, text).mapInArrow(run, "word binary, n bigint")
    return cut_lineage(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "vocabulary")


def flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64)


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each of 256 letters: the most frequent ones apart, the others where the sum is least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(256, np.int64)
        for batch in batches:
            sums += np.bincount(flat(batch.column("word").to_pylist())[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(sums)], ["letter", "n"])

    counted = words.select("word").mapInArrow(run, "letter int, n bigint").groupBy("letter").agg(F.sum("n").alias("n"))
    sums, out = [0] * GROUPS, np.zeros(256, np.int64)
    # At most 256 rows.
    for r in sorted(counted.collect(), key=lambda r: (-r.n, r.letter)):
        out[r.letter] = least = sums.index(min(sums))
        sums[least] += r.n
    return out


def counts(words: list[bytes], groups: np.ndarray) -> np.ndarray:
    """A row per word: its length and its letters in each group."""
    letters, lengths = flat(words)
    owner = np.repeat(np.arange(len(words)), lengths)
    per_group = np.bincount(owner * GROUPS + groups[letters], minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return np.column_stack([lengths, per_group])


# --- the top of the trie ------------------------------------------------------------------------


def steps(mode: np.ndarray, spent: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Which states may go down to which child: (states, difference of its count, budget spent by it)."""
    every = np.arange(len(mode))
    yield every, 0, 0
    if level:
        yield every[(mode != MEMBER) & (spent == 0)], 1, 1
        yield every[(mode == SAME) & (spent == 1)], -1, 1


def deeper(path: np.ndarray, mode: np.ndarray, spent: np.ndarray, own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """All states one level down; `own[at]` are the words' counts. `at` goes with its states."""
    level = path.shape[1]
    out = []
    for states, difference, cost in steps(mode, spent, level):
        count = own[at[states], level] + difference
        ok = count >= 0
        states = states[ok]
        out.append((np.column_stack([path[states], count[ok]]), mode[states], spent[states] + cost, at[states]))
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


def write_states(batch: pa.RecordBatch, path: np.ndarray, mode: np.ndarray, spent: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    data = pa.py_buffer(path.astype("<i4").tobytes())
    paths = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * path.shape[1]), len(path), [None, data]).cast(pa.binary())
    rows = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [batch.column("word").take(rows), batch.column("n").take(rows), paths, pa.array(mode, pa.int8()), pa.array(spent, pa.int8())],
        ["word", "n", "path", "mode", "spent"],
    )


def lay_out(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """Every word as a member of its node, and as an asker of the nodes that can hold a word next to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = counts(batch.column("word").to_pylist(), groups)
            at = np.tile(np.arange(batch.num_rows), 3)
            mode = np.repeat([MEMBER, SAME, LONGER], batch.num_rows)
            path, spent = (own[at, 0] + (mode == LONGER))[:, None], np.zeros(len(at), np.int64)
            for _ in range(FIRST_LEVELS):
                path, mode, spent, at = deeper(path, mode, spent, own, at)
            yield write_states(batch, path, mode, spent, at)

    return words.mapInArrow(run, STATE)


def one_level_down(states: DataFrame, groups: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = counts(batch.column("word").to_pylist(), groups)
            path = np.frombuffer(b"".join(batch.column("path").to_pylist()), "<i4").reshape(batch.num_rows, -1)
            mode, spent = (batch.column(c).to_numpy().astype(np.int64) for c in ("mode", "spent"))
            yield write_states(batch, *deeper(path, mode, spent, own, np.arange(batch.num_rows)))

    return states.select("word", "n", "path", "mode", "spent").mapInArrow(run, STATE)


def settled_nodes(words: DataFrame, groups: np.ndarray) -> tuple[DataFrame, DataFrame | None]:
    """States of the nodes that a task can hold, and of crowded leaves if there are any.

    Crowded nodes are fewer than one in `NODE_ROWS` states.
    """
    states = cut_lineage(lay_out(words, groups), "states")
    small = None
    for level in range(FIRST_LEVELS, GROUPS + 1):
        nodes = states.groupBy("path").agg(F.count("*").alias("rows"), F.sum(F.length("word")).alias("bytes"))
        crowded = cut_lineage(nodes.filter((F.col("rows") > NODE_ROWS) | (F.col("bytes") > NODE_BYTES)).select("path"), "crowded")
        if crowded.isEmpty():
            return states if small is None else small.unionByName(states), None
        crowded = F.broadcast(crowded) if fits(crowded) else crowded
        part, deep = states.join(crowded, "path", "left_anti"), states.join(crowded, "path", "left_semi")
        small = part if small is None else small.unionByName(part)
        if level == GROUPS:
            return small, deep
        states = cut_lineage(one_level_down(deep, groups), "states")
    raise AssertionError("unreachable")


# --- the walk down ------------------------------------------------------------------------------


class Trie:
    """Members of one length, sorted by their counts: a node is a range of them."""

    def __init__(self, own: np.ndarray) -> None:
        self.order = np.lexsort(own.T[::-1])
        own = own[self.order]
        self.width = int(own.max()) + 2
        self.levels, node = [], np.zeros(len(own), np.int64)
        for column in own.T:
            begins = np.r_[True, (node[1:] != node[:-1]) | (column[1:] != column[:-1])]
            first = np.flatnonzero(begins)
            self.levels.append(node[first] * self.width + column[first])
            node = np.cumsum(begins) - 1
        self.begins = np.r_[first, len(own)]

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states have such a child, and the child."""
        keys = self.levels[level]
        wanted = node * self.width + count
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = (keys[place] == wanted) & (count >= 0) & (count < self.width)
        return np.flatnonzero(found), place[found]

    def walk(self, asked: np.ndarray, mode: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Leaves within the budget: (askers, leaves, budget spent), depth-first in blocks of states."""
        stack = []
        for begin in range(0, len(asked), WALK):
            askers = np.arange(begin, min(begin + WALK, len(asked)))
            stack.append((0, askers, np.zeros(len(askers), np.int64), np.zeros(len(askers), np.int64)))
        while stack:
            level, askers, node, spent = stack.pop()
            if level == len(self.levels):
                yield askers, node, spent
                continue
            parts = []
            for states, difference, cost in steps(mode[askers], spent, level):
                has, child = self.child(level, node[states], asked[askers[states], level] + difference)
                states = states[has]
                parts.append((askers[states], child, spent[states] + cost))
            askers, node, spent = (np.concatenate(p) for p in zip(*parts, strict=True))
            for begin in range(0, len(askers), STATES):
                block = slice(begin, begin + STATES)
                stack.append((level + 1, askers[block], node[block], spent[block]))


def one_replaced(a: np.ndarray, b: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rows of equal length that differ in one letter; where `ordered`, b's is the larger."""
    differ = a != b
    at = differ.argmax(axis=1)
    row = np.arange(len(a))
    return (differ.sum(axis=1) == 1) & (~ordered | (b[row, at] > a[row, at]))


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of b that are a row of a with one letter more: a common start and a common end cover all of a."""
    start = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    end = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return start + end >= a.shape[1]


def search_node(table: pa.Table, groups: np.ndarray) -> pa.Table:
    """Verified pairs of a node's askers and members."""
    mode = table.column("mode").to_numpy().astype(np.int64)
    words = np.array(table.column("word").to_pylist() + [None], object)[:-1]
    members = np.flatnonzero(mode == MEMBER)
    askers = np.flatnonzero(mode != MEMBER)
    if not len(members) or not len(askers):
        return pa.table({c: pa.array([], k) for c, k in (("word", pa.binary()), ("n", pa.int64()), ("other", pa.binary()), ("other_n", pa.int64()))})
    trie = Trie(counts(list(words[members]), groups))
    members = members[trie.order]
    long = len(words[members[0]])
    letters = np.frombuffer(b"".join(words[members]), np.uint8).reshape(len(members), long)
    by_mode = {}
    for kind, length in ((SAME, long), (LONGER, long - 1)):
        rows = askers[mode[askers] == kind]
        by_mode[kind] = np.frombuffer(b"".join(words[rows]), np.uint8).reshape(len(rows), length)
    own = counts(list(words[askers]), groups)
    own[:, 0] = long
    kinds = mode[askers]
    # An asker's row among those of its kind.
    place = np.where(kinds == SAME, np.cumsum(kinds == SAME), np.cumsum(kinds == LONGER)) - 1
    low, high = [], []
    for who, leaf, spent in trie.walk(own, kinds):
        size = trie.begins[leaf + 1] - trie.begins[leaf]
        ends = np.cumsum(size)
        step = max(1, LETTERS // long)
        total = int(ends[-1]) if len(ends) else 0
        for begin in range(0, total, step):
            pair = np.arange(begin, min(begin + step, total))
            state = np.searchsorted(ends, pair, side="right")
            other = trie.begins[leaf[state]] + pair - (ends[state] - size[state])
            asker = who[state]
            near = np.zeros(len(pair), bool)
            for kind in (SAME, LONGER):
                mine = kinds[asker] == kind
                a, b = by_mode[kind][place[asker[mine]]], letters[other[mine]]
                near[mine] = one_replaced(a, b, spent[state[mine]] == 0) if kind == SAME else one_inserted(a, b)
            low.append(askers[asker[near]])
            high.append(members[other[near]])
    low, high = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (low, high))
    pairs = table.select(["word", "n"])
    a, b = pairs.take(pa.array(low)), pairs.take(pa.array(high))
    return pa.table({"word": a["word"], "n": a["n"], "other": b["word"], "other_n": b["n"]})


PAIR = "word binary, n bigint, other binary, other_n bigint"


def crowded_pairs(states: DataFrame) -> DataFrame:
    """Pairs within crowded leaves, by joins on the words without one letter."""
    at = F.col("at")
    cut = states.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("word")))).withColumns(
        {
            "rest": F.concat(F.substring("word", F.lit(1), at - 1), F.substring("word", at + 1, F.length("word"))),
            # Of a run of equal letters only the first is taken out.
            "again": (at > 1) & (F.substring("word", at, F.lit(1)) == F.substring("word", at - 1, F.lit(1))),
        }
    )
    member = F.col("mode") == MEMBER
    found = cut.filter(member).select("path", "at", "rest", "again", F.col("word").alias("other"), F.col("n").alias("other_n"))
    same = cut.filter(F.col("mode") == SAME).select("path", "at", "rest", "spent", "word", "n").join(found, ["path", "at", "rest"])
    same = same.filter((F.col("spent") == 2) | (F.col("other") > F.col("word")))
    longer = states.filter(F.col("mode") == LONGER).select("path", F.col("word").alias("rest"), "word", "n")
    longer = longer.join(found.filter("NOT again"), ["path", "rest"])
    columns = ["word", "n", "other", "other_n"]
    return same.select(*columns).unionByName(longer.select(*columns))


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs of words one edit apart, each once: (word, n, other, other_n)."""
    groups = letter_groups(words)
    small, crowded = settled_nodes(words, groups)

    def work(table: pa.Table) -> pa.Table:
        return search_node(table.combine_chunks(), groups)

    pairs = small.groupBy("path").applyInArrow(work, PAIR)
    return pairs if crowded is None else pairs.unionByName(crowded_pairs(crowded))


# --- forms --------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form; a hop is doubled until it ends at a word without one.

    Counts at least double from word to form, so there are few rounds.
    """
    hops = cut_lineage(forms.select("word", F.col("form").alias("root")), "hops")
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        met = cut_lineage(hops.join(ahead, "root", "left"), "hops")
        if met.filter("ahead IS NOT NULL").isEmpty():
            return hops
        hops = met.select("word", F.coalesce("ahead", "root").alias("root"))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: `form`, its near word of the largest count if that is large enough; `root`; counts."""
    words = vocabulary(docs, key, text)
    pairs = cut_lineage(near_pairs(words), "pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    enough = -F.col("best.m") >= FORM_SHARE * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        F.when(enough, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    known = cut_lineage(known, "forms")
    rooted = known.join(roots(known.filter("form IS NOT NULL")), "word", "left")
    return rooted.select(
        *[F.decode(c, "ISO-8859-1").alias(c) for c in ("word", "form")],
        F.decode(F.coalesce("root", "word"), "ISO-8859-1").alias("root"),
        "n",
        "n_near",
        "form_n",
    )
