"""Byte-level BPE encoding and decoding with recursive queries.

A text is cut into units in front of blanks, within which the pattern's matches
do not depend on what surrounds them. A worker encodes each unit once: the pieces
it lacks become rows (piece, position, id), and a recursive DuckDB query joins
neighbours with the table of merges and contracts, in each piece, the leftmost
pair of least rank until none is left. Decoding is an ordered aggregation of the
ids' bytes. Each Spark partition works with a DuckDB database of its own, in
memory and in one thread.
"""

from __future__ import annotations

import base64
import bisect
import gc
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm import common

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# Units and pieces that a worker keeps of each generation, bytes of pieces in one
# recursive query, and characters of text or ids it takes at a time.
GENERATION = 600_000
QUERY_BYTES = 250_000
CHUNK = 3_000_000

# Pieces of more bytes than this are merged with all steps in one table.
LONG = 48

# White space of Unicode, as the pattern's \s has it; Python's own \s has more.
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNITS = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
# Letters that every alphabet table has as such, and marks that may follow them; of
# a pattern that parts them from letters, as the usual one does.
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_MARKS = ".,;:!?|*&$%#)"
_GAPS = re.compile(f" [{_BLANK}]|[{_BLANK}] ")

# The states of all steps, of which the last of each piece counts.
MERGE = """
WITH RECURSIVE state(step, piece, pos, id) AS (
  SELECT 0, piece, pos, id FROM start_rows
  UNION ALL (
    WITH neighbours AS (
      SELECT piece, pos, id, lead(id) OVER w AS next_id, lead(pos) OVER w AS next_pos
      FROM state WINDOW w AS (PARTITION BY piece ORDER BY pos)
    ), best AS (
      SELECT n.piece, min({'id': m.id, 'pos': n.pos, 'next_pos': n.next_pos}) AS pair
      FROM neighbours n JOIN merges m ON m.left_id = n.id AND m.right_id = n.next_id
      GROUP BY n.piece
    )
    SELECT s.step + 1, s.piece, s.pos, CASE WHEN s.pos = pair.pos THEN pair.id ELSE s.id END
    FROM state s JOIN best ON best.piece = s.piece AND s.pos <> pair.next_pos
  )
)
SELECT piece, id FROM state
WHERE (piece, step) IN (SELECT (piece, max(step)) FROM state GROUP BY piece)
ORDER BY piece, pos
"""

# For long pieces: only the last state is kept, and pairs of the least rank are all contracted in one step where no pair with the
# new id has a lower rank (everywhere); of a chain of equal ids every other one.
# Otherwise the leftmost alone is.
MERGE_LONG = """
WITH RECURSIVE state(piece, pos, id) USING KEY (piece, pos) AS (
  SELECT piece, pos, id FROM start_rows
  UNION ALL (
    WITH neighbours AS (
      SELECT piece, pos, id, lead(id) OVER w AS next_id, lead(pos) OVER w AS next_pos,
        row_number() OVER w AS place
      FROM state WHERE id IS NOT NULL WINDOW w AS (PARTITION BY piece ORDER BY pos)
    ), pairs AS (
      SELECT n.piece, n.pos, n.next_pos, n.place, m.id, m.everywhere
      FROM neighbours n JOIN merges m ON m.left_id = n.id AND m.right_id = n.next_id
    ), least AS (
      SELECT piece, min(id) AS id FROM pairs GROUP BY piece
    ), best AS (
      SELECT pairs.*, row_number() OVER (PARTITION BY pairs.piece ORDER BY place) AS nth
      FROM pairs JOIN least ON least.piece = pairs.piece AND least.id = pairs.id
    ), chosen AS (
      SELECT piece, pos, next_pos, id FROM (
        SELECT *, row_number() OVER c AS in_chain
        FROM best WINDOW c AS (PARTITION BY piece, place - nth ORDER BY place)
      ) WHERE CASE WHEN everywhere THEN in_chain % 2 = 1 ELSE nth = 1 END
    )
    SELECT n.piece, n.pos,
      CASE WHEN l.pos IS NOT NULL THEN l.id WHEN r.next_pos IS NULL THEN n.id END
    FROM neighbours n
    SEMI JOIN least ON least.piece = n.piece
    LEFT JOIN chosen l ON l.piece = n.piece AND l.pos = n.pos
    LEFT JOIN chosen r ON r.piece = n.piece AND r.next_pos = n.pos
  )
)
SELECT piece, id FROM state WHERE id IS NOT NULL ORDER BY piece, pos
"""

# Bytes travel as the characters of the same number. The database has one thread,
# so rows reach the aggregation in the order of the inner query; sorting them there
# at once takes a third of the time of sorting each group.
DECODE = """
SELECT text, string_agg(bytes, '') AS bytes
FROM (
  SELECT t.text, v.bytes FROM token_rows t JOIN vocabulary v USING (id) ORDER BY t.pos
) GROUP BY text
"""


class Generations:
    """A bounded cache: what is not asked for during a whole generation goes."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.young) > GENERATION:
            self.old, self.young = self.young, {}

    def lacking(self, keys: set[str]) -> list[str]:
        """Keys that are in neither generation; those in the old one become young."""
        absent = keys.difference(self.young)
        if self.old:
            self.young.update((k, self.old[k]) for k in absent if k in self.old)
            absent = absent.difference(self.young)
        return list(absent)


class Codec:
    """Merges and vocabulary of one file of ranks, and the units encoded so far."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.pattern = regex.compile(pattern)
        # Units and pieces that begin with a blank by what follows it, and others.
        self.spaced, self.others = Generations(), Generations()
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.database = duckdb.connect(config={"threads": 1})
        pairs = [
            (self.ranks[left], self.ranks[right], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in self.ranks and (right := token[cut:]) in self.ranks
        ]
        left, right, rank = (np.array(c, np.int32) for c in zip(*pairs, strict=True))
        early = np.unique(np.concatenate([left[rank < left], right[rank < right]]))
        merges = pa.table(  # noqa: F841 - DuckDB reads it by name
            {
                "left_id": left,
                "right_id": right,
                "id": rank,
                "everywhere": ~np.isin(rank, early),
            }
        )
        vocabulary = pa.table(  # noqa: F841
            {
                "id": pa.array(list(self.ranks.values()), pa.int32()),
                "bytes": [token.decode("latin-1") for token in self.ranks],
            }
        )
        for name in ("merges", "vocabulary"):
            self.database.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}")

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; pieces of like length share a query."""
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        out = [b""] * len(pieces)
        sizes = [len(pieces[i]) for i in order]
        short = bisect.bisect_right(sizes, LONG)
        for query, low, high in ((MERGE, 0, short), (MERGE_LONG, short, len(order))):
            for first, last in common.chunks(sizes[low:high], QUERY_BYTES):
                part = order[low + first : low + last]
                merged = self._merged(query, [pieces[i] for i in part])
                for i, own in zip(part, merged, strict=True):
                    out[i] = own
        return out

    def _merged(self, query: str, pieces: list[bytes]) -> list[bytes]:
        size = np.array(list(map(len, pieces)))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        start_rows = pa.table(  # noqa: F841
            {
                "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), size),
                "pos": np.arange(len(flat), dtype=np.int32),
                "id": self.bytes[flat],
            }
        )
        merged = self.database.sql(query).to_arrow_table()
        owner, ids = (merged.column(i).to_numpy() for i in (0, 1))
        raw = ids.astype("<i4").tobytes()
        ends = 4 * np.searchsorted(owner, np.arange(len(pieces) + 1))
        return [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def learn(self, others: set[str], spaced: set[str]) -> None:
        """Take up units: those after a blank by what follows it, and others.

        A word of plain letters is one piece, and so are marks behind it.
        """
        self.spaced.turn()
        self.others.turn()
        single, rest = self.spaced.young, self.others.young
        joined: list[tuple[str, str, str]] = []
        plain: set[str] = set()
        marks: set[str] = set()
        split: list[tuple[dict[str, bytes], str, list[str]]] = []
        find = self.pattern.findall
        for unit in self.spaced.lacking(spaced):
            head = unit.rstrip(_MARKS)
            if not _LETTERS.fullmatch(head):
                split.append((single, unit, find(" " + unit)))
                continue
            plain.add(head)
            if len(head) < len(unit):
                marks.add(unit[len(head) :])
                joined.append((unit, head, unit[len(head) :]))
        split += [(rest, unit, find(unit)) for unit in self.others.lacking(others)]
        wanted = set(chain.from_iterable(pieces for _, _, pieces in split))
        plain.update(p[1:] for p in wanted if p[:1] == " ")
        marks.update(p for p in wanted if p[:1] != " ")
        # These are pieces; what the old generation has of them is taken over.
        behind, alone = self.spaced.lacking(plain), self.others.lacking(marks)
        new = [(single, p, b" " + p.encode()) for p in behind]
        new += [(rest, p, p.encode()) for p in alone]
        longer = []
        for into, piece, raw in new:
            known = self.ranks.get(raw)
            if known is None:
                longer.append((into, piece, raw))
            else:
                into[piece] = known.to_bytes(4, "little")
        merged = self.merge([raw for _, _, raw in longer])
        for (into, piece, _), ids in zip(longer, merged, strict=True):
            into[piece] = ids
        for unit, head, tail in joined:
            single[unit] = single[head] + rest[tail]
        for into, unit, pieces in split:
            into[unit] = b"".join(
                [single[p[1:]] if p[:1] == " " else rest[p] for p in pieces]
            )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # Many small objects but no cycles: the collector would only look through
        # the caches again and again.
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        plain: list[list[str]] = []
        spaced: list[list[str]] = []
        for text in texts:
            # A blank that has another beside it belongs to a longer run of blanks.
            if _GAPS.search(text):
                plain.append(_UNITS.findall(text))
                spaced.append([])
            else:
                first, *rest = text.split(" ")
                plain.append([first])
                spaced.append(rest)
        self.learn(set(chain.from_iterable(plain)), set(chain.from_iterable(spaced)))
        of, behind = self.others.young.__getitem__, self.spaced.young.__getitem__
        return [
            np.frombuffer(b"".join([*map(of, a), *map(behind, b)]), "<i4")
            for a, b in zip(plain, spaced, strict=True)
        ]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        out = [b""] * len(ids)
        sizes = np.array([len(i) for i in ids], np.int64)
        flat = np.concatenate([np.empty(0, np.int32), *ids])
        token_rows = pa.table(  # noqa: F841
            {
                "text": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
                "pos": np.arange(len(flat), dtype=np.int64),
                "id": flat,
            }
        )
        found = self.database.sql(DECODE).to_arrow_table()
        for at, text in zip(*(c.to_pylist() for c in found.columns), strict=True):
            out[at] = text.encode("latin-1")
        return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _texts(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return common.blank(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
        "text",
    )


def _encoded(
    documents: DataFrame, doc_id: str, text: str, ranks: str, pattern: str, back: bool
) -> DataFrame:
    rows = _texts(documents, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            for first, last in common.chunks(sizes, CHUNK):
                part = batch.slice(first, last - first)
                ids = own.encode(common.text_column(part, "text"))
                columns = [part.column("doc_id"), _lists(ids)]
                if back:
                    columns.append(pa.array(own.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "ids", *["decoded"] * back]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", decoded binary" * back
    return common.map_arrow(rows, run, schema)


def encode(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    ranks: str = RANKS,
    pattern: str = PATTERN,
) -> DataFrame:
    """``doc_id, ids``: token ids of every whole text, a row for each row.

    Special tokens are not looked for: their strings are ordinary text. A null
    text is empty and has no ids. Other columns are left out.
    """
    return _encoded(documents, doc_id, text, ranks, pattern, back=False)


def encode_and_decode(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    ranks: str = RANKS,
    pattern: str = PATTERN,
) -> DataFrame:
    """``doc_id, ids, decoded``: as ``decode(encode(documents))``, in one worker."""
    return _encoded(documents, doc_id, text, ranks, pattern, back=True)


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, ids, decoded`` of rows with ``doc_id, ids``; ``decoded`` is binary.

    Null ids read as none; an id that the vocabulary lacks has no bytes.
    """
    none = F.array().cast("array<int>")
    rows = encoded.select("doc_id", F.coalesce("ids", none).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            ids = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for first, last in common.chunks(map(len, ids), CHUNK):
                texts = pa.array(own.decode(ids[first:last]), pa.binary())
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, texts], ["doc_id", "ids", "decoded"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, ids array<int>, decoded binary")
