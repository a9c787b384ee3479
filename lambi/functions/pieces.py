"""Longest-match tokens over a vocabulary table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

#: Id of what no piece covers, and most pieces of a vocabulary (it is sent to all tasks).
UNKNOWN, MOST_PIECES = 0, 1_000_000
#: Characters that a numpy step looks at together.
SLICE = 1 << 20
_BLANK = np.array([9, 10, 11, 12, 13, 32])
TOKEN = StructType([StructField(x, IntegerType()) for x in ("id", "start", "end")])


class Trie:
    """Pieces as a double array: the child of node s by character code c is t = base[s] + c, if
    check[t] = s; value[t] is the id of the piece that ends there, or UNKNOWN."""

    def __init__(self, pieces: dict[str, int]):
        letters = sorted({c for p in pieces for c in p})
        self.codes = np.zeros(0x110000, dtype=np.int32)
        self.codes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.depth = max(map(len, pieces), default=0)
        size = 1024
        base, check, value = ([0] * size for _ in range(3))
        taken, first = [True] + [False] * (size - 1), 1
        code = {c: i for i, c in enumerate(letters, 1)}
        waiting = [(0, sorted((p, i) for p, i in pieces.items() if p), 0)]
        while waiting:
            node, below, depth = waiting.pop()
            children: dict[int, list] = {}
            for p, i in below:
                if len(p) == depth:
                    value[node] = i
                else:
                    children.setdefault(code[p[depth]], []).append((p, i))
            if not children:
                continue
            lo, hi = min(children), max(children)
            at = began = max(1, first - lo)
            while True:
                if at + hi >= len(taken):
                    more = len(taken)
                    for xs, x in ((base, 0), (check, 0), (value, 0), (taken, False)):
                        xs.extend([x] * more)
                if not any(taken[at + c] for c in children):
                    break
                at += 1
            if at - began > 64:  # crowded from here on back
                first = at + lo
            base[node] = at
            for c, part in children.items():
                taken[at + c], check[at + c] = True, node
                waiting.append((at + c, part, depth + 1))
        pad = [0] * (len(letters) + 2)
        self.base, self.check, self.value = (np.array(x + pad, dtype=np.int32) for x in (base, check, value))
        self.check[[i for i, t in enumerate(taken) if not t]] = -1
        self.check[0] = self.check[len(taken) :] = -1

    def longest(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and id of the longest piece from each place on (0 and UNKNOWN if there is none);
        all places walk down the trie together."""
        n = len(letters)
        codes = np.append(self.codes[letters], np.zeros(self.depth, np.int32))
        length, ids = np.zeros(n, dtype=np.int32), np.full(n, UNKNOWN, dtype=np.int32)
        at, node = np.arange(n), np.zeros(n, dtype=np.int32)
        for d in range(self.depth):
            code = codes[at + d]
            child = self.base[node] + code
            on = (code > 0) & (self.check[child] == node)
            at, node = at[on], child[on]
            ends = self.value[node] != UNKNOWN
            length[at[ends]], ids[at[ends]] = d + 1, self.value[node[ends]]
        return length, ids

    def tokens(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts and ends of the tokens in order: from the start of each word (blanks and -1 part
        words) the longest piece, again and again; letters without a piece in a row are one unknown."""
        gap = np.isin(letters, _BLANK) | (letters < 0)
        letters = np.where(letters < 0, 0x20, letters)
        length, ids = self.longest(letters)
        edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
        at, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        begins = [np.zeros(0, np.int64)]
        while len(at):
            begins.append(at)
            at = at + np.maximum(length[at], 1)
            on = at < stop
            at, stop = at[on], stop[on]
        start = np.sort(np.concatenate(begins))
        known = ids[start] != UNKNOWN
        end = start + np.maximum(length[start], 1)
        joined = np.zeros(len(start), dtype=bool)
        joined[1:] = ~known[1:] & ~known[:-1] & (end[:-1] == start[1:])
        head = np.flatnonzero(~joined)
        tail = np.append(head[1:], len(start)) - 1
        return ids[start[head]], start[head], end[tail] if len(head) else end[:0]


def word_counts(df: DataFrame, text: str, name: str = "word") -> DataFrame:
    """(name, n): the distinct words of all texts, parted by blanks, and how often each occurs.

    No token crosses a blank, so the tokens of a word, taken once, stand for all its occurrences. Spark
    sums before it shuffles, and what reaches Python is as large as the distinct words.
    """
    words = F.explode(F.split(text, r"[\x09-\x0D\x20]+"))
    return df.select(words.alias(name)).where(F.col(name) != "").groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def tokenizer(vocabulary: DataFrame, piece: str = "piece", number: str = "id"):
    """A function from a text column to its tokens, an array of (id, start, end in characters), by
    longest match over the pieces of a table.

    Words are parted by blanks, and so pieces with a blank never match. Ids are whole numbers above 0;
    of a piece listed twice the least id counts; null or empty pieces are left out. The vocabulary is
    collected and sent to all tasks: at most `MOST_PIECES` pieces, else ValueError. Null and empty
    texts have no tokens.
    """
    rows = vocabulary.where((F.length(piece) > 0) & F.col(number).isNotNull()).groupBy(piece).agg(F.min(number)).limit(MOST_PIECES + 1).collect()
    if len(rows) > MOST_PIECES:
        raise ValueError(f"a vocabulary has at most {MOST_PIECES} pieces")
    trie = vocabulary.sparkSession.sparkContext.broadcast(Trie(dict(map(tuple, rows))))

    def slices(lengths: np.ndarray):
        ends, lo = np.cumsum(lengths), 0
        while lo < len(lengths):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
            yield lo, hi
            lo = hi

    @F.arrow_udf(ArrayType(TOKEN))
    def tokens(texts: pa.Array) -> pa.Array:
        texts = [t or "" for t in texts.to_pylist()]
        counts, columns = [np.zeros(1, np.int64)], [[], [], []]
        for lo, hi in slices(np.array([len(t) for t in texts], dtype=np.int64)):
            letters = np.frombuffer("\n".join(texts[lo:hi]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
            begin = np.cumsum([0, *(len(t) + 1 for t in texts[lo:hi])])
            ids, start, end = trie.value.tokens(letters)
            of = np.searchsorted(begin, start, side="right") - 1
            counts.append(np.bincount(of, minlength=hi - lo))
            for column, x in zip(columns, (ids, start - begin[of], end - begin[of])):
                column.append(x.astype(np.int32))
        fields = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int32)) for c in columns]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)), pa.int32()), pa.StructArray.from_arrays(fields, ["id", "start", "end"]))

    def apply(text: Column) -> Column:
        return tokens(text)

    return apply
