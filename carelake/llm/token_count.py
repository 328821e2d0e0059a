"""Token counts by a linear longest-match automaton.

The vocabulary becomes a trie. Every node has a failure link and the number
of pieces that are popped when matching falls back along it, both computed
beforehand, so one pass over a word gives the number of pieces that greedy
longest-match-first splitting would make, without building a piece and
without ever going back in the word.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+|[^\w\s]")
#: A word longer than this counts as unknown by default, as in the usual greedy
#: splitter; the registered query sets no limit.
LONGEST = 100
#: Counts remembered per task; forgotten all at once when full.
REMEMBERED = 300_000


def sentencepiece_vocabulary(model: bytes) -> list[str]:
    """Pieces of a SentencePiece model as a word-piece vocabulary: pieces that
    start a word stand bare, the others get the prefix ``##``."""
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    out = []
    for p in proto.pieces:
        if p.type == p.NORMAL and p.piece.strip("▁"):
            out.append(p.piece.lstrip("▁") if p.piece.startswith("▁") else "##" + p.piece)
    return out


class LongestMatch:
    """Counts greedy word pieces of single words."""

    def __init__(self, vocabulary: Iterable[str], prefix: str = "##"):
        # node 0 starts a word, node 1 stands after a popped piece
        self.next: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for piece in vocabulary:
            inner = piece.startswith(prefix) and len(piece) > len(prefix)
            node = 1 if inner else 0
            for c in piece[len(prefix):] if inner else piece:
                node = self.next[node].setdefault(c, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                    ends.append(False)
            if node > 1:
                ends[node] = True
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        queue = deque([0, 1])
        while queue:
            v = queue.popleft()
            for c, u in self.next[v].items():
                if ends[u]:
                    self.fail[u], self.pops[u] = 1, 1
                else:
                    f, pops = self.fail[v], self.pops[v]
                    while f >= 0 and c not in self.next[f]:
                        pops += self.pops[f]
                        f = self.fail[f]
                    if f >= 0:
                        self.fail[u], self.pops[u] = self.next[f][c], pops
                queue.append(u)

    def count(self, word: str) -> int:
        """Number of pieces, or 0 if the word can't be split."""
        goto, fail, pops = self.next, self.fail, self.pops
        node = total = 0
        for c in word:
            to = goto[node].get(c)
            while to is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
                to = goto[node].get(c)
            node = to
        while node > 1:
            total += pops[node]
            node = fail[node]
        return total if node == 1 else 0


_automata: dict[tuple, LongestMatch] = {}


def _counter(vocabulary: tuple[str, ...], lower: bool, longest: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (len(vocabulary), hash(vocabulary))
        if key not in _automata:
            _automata[key] = LongestMatch(vocabulary)
        count, known = _automata[key].count, {}
        for batch in batches:
            words, tokens, unknown = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                found = WORD.findall(text.lower() if lower else text) if text else []
                total = bad = 0
                for w in found:
                    n = known.get(w)
                    if n is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        n = count(w) if longest is None or len(w) <= longest else 0
                        if len(w) <= LONGEST:  # longer ones hardly come again
                            known[w] = n
                    if n:
                        total += n
                    else:
                        bad += 1
                words.append(len(found))
                tokens.append(total + bad)
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"])
    return run


def oracle_sql(vocabulary: Iterable[str], prefix: str = "##") -> str:
    """DuckDB SQL of (doc_id, n_words, n_tokens, n_unknown) over ``documents``
    without a limit on words: each distinct word is split piece by piece, the
    longest first, by looking up every substring. The vocabulary is a VALUES list."""
    pieces = sorted(set(vocabulary))
    rows = ", ".join("('" + p.replace("'", "''") + "')" for p in pieces)
    longest = max(map(len, pieces))
    return rf"""
WITH RECURSIVE p(piece) AS MATERIALIZED (VALUES {rows}),
w AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''),
    '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\p{{Z}}\x0B\x1C-\x1F\x{{85}}]')) AS word FROM documents),
d AS MATERIALIZED (SELECT word, length(word) AS n FROM (SELECT DISTINCT word FROM w)),
g(word, n, pos, made) AS (
  SELECT word, n, 0, 0 FROM d
  UNION ALL
  SELECT word, n, pos + max(k), made + 1
  FROM (SELECT *, unnest(range(1, least(n - pos, {longest}) + 1)) AS k FROM g WHERE pos < n) c
  JOIN p ON p.piece = (CASE WHEN c.pos = 0 THEN '' ELSE '{prefix}' END) || substr(c.word, c.pos + 1, c.k)
  GROUP BY word, n, pos, made),
m AS (SELECT word, made FROM g WHERE pos = n),
t AS (
  SELECT doc_id, count(*) AS n_words, sum(coalesce(made, 1)) AS n_tokens, count(*) FILTER (WHERE made IS NULL) AS n_unknown
  FROM w LEFT JOIN m USING (word) GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(n_tokens, 0) AS BIGINT) AS n_tokens, coalesce(n_unknown, 0) AS n_unknown
FROM documents LEFT JOIN t USING (doc_id)"""


def token_counts(docs: DataFrame, vocabulary: Iterable[str], id_col: str = "doc_id", text_col: str = "text",
                 lower: bool = False, longest: int | None = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown), one row per row of ``docs``.

    Words are runs of word characters, and single other characters but white
    space. A word that can't be split (or is longer than ``longest``, if
    that is not None) counts as one unknown token; n_tokens includes those. Null and empty texts have
    counts of 0. Other columns are not read; null ids are kept."""
    ids = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _counter(tuple(vocabulary), lower, longest), f"doc_id {ids}, n_words long, n_tokens long, n_unknown long")
