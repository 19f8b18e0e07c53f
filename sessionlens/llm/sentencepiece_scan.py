"""SentencePiece encoding and decoding, with a parallel scan for giant texts.

Texts up to ``chunk_chars`` are encoded by the installed library. Longer ones are cut into
chunks that are worked on independently, by a scan in the max-plus semiring:

* The model at hand is a BPE model. A sequence of pieces is the BPE encoding of a text
  exactly if every two neighbours are: ``merge(a + b) == [a, b]``. So the encoding is the
  only path through the lattice of pieces whose neighbours are all compatible; a step has
  the weight 1 if it is compatible and minus infinity if not.
* The state at a boundary between chunks is the piece that covers it. Each chunk yields the
  matrix from the possible pieces at its left boundary to those at its right one (the number
  of pieces on the way, or minus infinity).
* Matrices are combined associatively per text (``combine``); the one finite path gives the
  state at every boundary. Then every chunk is traced back on its own from its known state.

A position before a run of spaces is never inside a piece and has only one state. Between the
first and the last such position of a chunk the library is used.

The vocabulary file is a parameter and is read by every Python worker from its own
installation. Defined results: null and empty texts have no pieces and decode to the empty
text; equal texts get equal ids; an empty table gives an empty result. The model reads
U+2581 as a space, so only texts with that character don't return from decoding unchanged.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 32_768
SPACE = "▁"
Token = tuple[int, int]  # start and end


class Pieces:
    """A model's vocabulary with the library's encoder."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(self.library)
        special = {i for i in range(n) if self.library.is_control(i) or self.library.is_byte(i) or self.library.is_unknown(i) or self.library.is_unused(i)}
        self.ids = {self.library.id_to_piece(i): i for i in range(n) if i not in special}
        self.scores = {p: self.library.get_score(i) for p, i in self.ids.items()}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        self.fits = lru_cache(1 << 18)(self._fits)

    def merge(self, text: str) -> list[str]:
        """BPE of a short string: the best pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best[0]):
                    best = score, k
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def _fits(self, left: str, right: str) -> bool:
        return self.merge(left + right) == [left, right]

    def numbers(self, piece: str) -> list[int]:
        """Ids of a piece, or of its bytes if the vocabulary lacks it."""
        known = self.ids.get(piece)
        return [known] if known is not None else [self.bytes[b] for b in piece.encode()]

    def encode_inner(self, text: str) -> list[int]:
        """Ids of a part that begins with a space sign. The library puts one before its input."""
        return self.library.encode(text[1:].replace(SPACE, " ")) if len(text) > 1 else self.numbers(text)


@lru_cache(2)
def pieces(path: str = MODEL) -> Pieces:
    return Pieces(path)


def normal(text: str) -> str:
    """What the model sees: one space sign more in front, and one for each space."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def safe_points(text: str, first: int, last: int) -> Iterator[int]:
    """Positions p with first <= p <= last before a run of spaces."""
    p = text.find(SPACE, max(first, 1))
    while p != -1 and p <= last:
        if text[p - 1] != SPACE:
            yield p
        p = text.find(SPACE, p + 1)


def covering(text: str, at: int, model: Pieces) -> list[Token]:
    """The pieces that may cover a boundary: start < at <= end."""
    out = []
    for start in range(max(0, at - model.longest), at):
        for end in range(at, min(len(text), start + model.longest) + 1):
            if end == start + 1 or text[start:end] in model.ids:
                out.append((start, end))
    return out


def lattice(text: str, sources: list[Token | None], begin: int, stop: int, model: Pieces) -> dict[Token, dict[int, tuple[int, Token | None]]]:
    """All pieces that compatible paths from the sources reach, up to those that end at or after ``stop``.

    For each piece: source number -> (pieces on the way, piece before). A source None is a
    free start at ``begin``.
    """
    reached: dict[Token | None, dict[int, tuple[int, Token | None]]] = {}
    queue: list[tuple[int, int]] = []
    for k, source in enumerate(sources):
        reached.setdefault(source, {})[k] = (0, None)
        heapq.heappush(queue, (source[1], source[0]) if source else (begin, -1))
    done: set[Token | None] = set()
    while queue:
        at, start = heapq.heappop(queue)
        node = (start, at) if start >= 0 else None
        if node in done or at >= stop:
            continue
        done.add(node)
        left = text[start:at] if node else ""
        for end in range(at + 1, min(len(text), at + model.longest) + 1):
            piece = text[at:end]
            if (end > at + 1 and piece not in model.ids) or (left and not model.fits(left, piece)):
                continue
            new = (at, end)
            if new not in reached:
                reached[new] = {}
                heapq.heappush(queue, (end, at))
            for k, (count, _) in reached[node].items():
                reached[new].setdefault(k, (count + 1, node))
    return reached


def path_to(node: Token, source: int, reached: dict) -> list[Token]:
    """The pieces from a source (left out) to ``node``."""
    out = []
    while node is not None and reached[node][source][0]:
        out.append(node)
        node = reached[node][source][1]
    return out[::-1]


class Chunk:
    """text[begin:end] of a whole text, with the context that its boundaries need."""

    def __init__(self, text: str, offset: int, begin: int, end: int, total: int, model: Pieces):
        self.text, self.offset, self.model = text, offset, model
        self.begin, self.end, self.first, self.final = begin - offset, end - offset, begin == 0, end == total
        self.safe = list(safe_points(text, self.begin, self.end - self.final))
        if self.first:
            self.safe.insert(0, 0)

    def sources(self) -> list[Token | None]:
        return [None] if self.first else covering(self.text, self.begin, self.model)

    def exits(self, reached: dict) -> list[Token]:
        return [x for x in reached if x is not None and x[1] >= self.end > x[0]]

    def head(self) -> dict | None:
        """From the left boundary to the first safe point, or to the end if there is none."""
        if self.safe and self.safe[0] == 0:
            return None
        return lattice(self.text, self.sources(), self.begin, self.safe[0] if self.safe else self.end, self.model)

    def tail(self) -> dict:
        return lattice(self.text, [None], self.safe[-1], self.end, self.model)

    def matrix(self) -> list[tuple[Token | None, Token, int]]:
        """Finite entries: state at the left, state at the right (in the whole text), number of pieces."""
        move = lambda x: None if x is None else (x[0] + self.offset, x[1] + self.offset)
        sources, head = self.sources(), self.head()
        if not self.safe:
            return [(move(sources[k]), move(x), n) for x in self.exits(head) for k, (n, _) in head[x].items()]
        inner = len(self.model.encode_inner(self.text[self.safe[0] : self.safe[-1]])) if self.safe[-1] > self.safe[0] else 0
        if head is None:
            starts = {None: 0}
        else:
            starts = {move(sources[k]): n for x in head if x is not None and x[1] == self.safe[0] for k, (n, _) in head[x].items()}
        if self.safe[-1] == self.end:  # nothing covers a safe point: the state is the piece that ends there
            return self._to_safe_end(starts, inner, move)
        tail = self.tail()
        return [(a, move(x), n + inner + m) for a, n in starts.items() for x in self.exits(tail) for m, _ in tail[x].values()]

    def _to_safe_end(self, starts: dict, inner: int, move) -> list[tuple[Token | None, Token, int]]:
        end = self.safe[-1]
        return [(a, (end + self.offset - 1, end + self.offset), n + inner) for a, n in starts.items()]

    def trace(self, entry: Token | None, leave: Token) -> list[int]:
        """Ids of the pieces after ``entry`` up to and with ``leave``."""
        local = lambda x: None if x is None else (x[0] - self.offset, x[1] - self.offset)
        entry, leave, out = local(entry), local(leave), []
        numbers = lambda path: [i for a, b in path for i in self.model.numbers(self.text[a:b])]
        sources, head = self.sources(), self.head()
        if not self.safe:
            return numbers(path_to(leave, sources.index(entry), head))
        if head is not None:
            k = sources.index(entry)
            last = [x for x in head if x is not None and x[1] == self.safe[0] and k in head[x]]
            out += numbers(path_to(last[0], k, head)) if last else []
        if self.safe[-1] > self.safe[0]:
            out += self.model.encode_inner(self.text[self.safe[0] : self.safe[-1]])
        if self.safe[-1] != self.end:
            tail = self.tail()
            out += numbers(path_to(leave, 0, tail))
        return out


def combine(left: list[tuple], right: list[tuple]) -> list[tuple]:
    """Product of two max-plus matrices, given as (from, to, weight, states between)."""
    by: dict = {}
    for a, b, w, path in left:
        by.setdefault(b, []).append((a, w, path))
    best: dict = {}
    for b, c, w, path in right:
        for a, v, before in by.get(b, ()):
            if (a, c) not in best or best[a, c][0] < v + w:
                best[a, c] = v + w, before + (b,) + path
    return [(a, c, w, path) for (a, c), (w, path) in best.items()]


def boundary_states(matrices: list[list[tuple]]) -> list[Token | None]:
    """State at each boundary of a text, its begin and end included, by a tree of products."""
    level = [[(a, b, w, ()) for a, b, w in m] for m in matrices]
    while len(level) > 1:
        level = [combine(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    (a, b, _, path), *more = [x for x in level[0] if x[0] is None]
    assert not more, "the encoding is one path"
    return [a, *path, b]


def cut(text: str, size: int, context: int) -> list[tuple[int, int, int, int, str]]:
    """Chunks of a normalised text: offset of the context, begin, end, length of all, the text."""
    n = len(text)
    edges = [0, *range(size, n - context, size), n]
    return [(max(0, a - context), a, b, n, text[max(0, a - context) : min(n, b + context)]) for a, b in zip(edges, edges[1:], strict=False)]


def encode_long(text: str, size: int = CHUNK_CHARS, path: str = MODEL) -> list[int]:
    """The scan over one text in this process, for tests."""
    if not text:
        return []
    model = pieces(path)
    chunks = [Chunk(t, o, a, b, n, model) for o, a, b, n, t in cut(normal(text), max(size, 4 * model.longest), 2 * model.longest)]
    states = boundary_states([c.matrix() for c in chunks])
    return [i for c, a, b in zip(chunks, states, states[1:], strict=False) for i in c.trace(a, b)]


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Per row: id, ``token_ids`` (array of int) and ``exact`` (whether decoding gives the text back)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    giant = F.length("text") > chunk_chars
    short = rows.filter(~giant).mapInArrow(_encode_short(path), f"id {id_type}, token_ids array<int>, exact boolean")
    long = _encoded_long(rows.filter(giant).select("id", "text", F.sha2("text", 256).alias("key")), path, chunk_chars)
    return short.unionByName(long).select(F.col("id").alias(id_col), "token_ids", "exact")


def _encode_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(path).library
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = library.encode(texts, num_threads=1)
                exact = [a == b for a, b in zip(library.decode(ids, num_threads=1), texts, strict=True)]
                sizes = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=sizes[1:])
                flat = np.concatenate([np.zeros(0, np.int32), *(np.asarray(x, np.int32) for x in ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(sizes, pa.array(flat, pa.int32())), pa.array(exact)], names=["id", "token_ids", "exact"])

    return run


def _encoded_long(rows: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    """The scan: equal texts once; chunks of all texts are spread over the cluster."""
    fields = ["key", "no", "offset", "begin", "end", "total", "text"]
    # state columns: piece that covers the left and the right boundary
    entry = "key string, no int, from_start long, from_end long, to_start long, to_end long"

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        size = max(chunk_chars, 4 * model.longest)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cuts = [(key, k, *c) for k, c in enumerate(cut(normal(text), size, 2 * model.longest))]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*cuts, strict=True), (pa.string(), pa.int32(), *[pa.int64()] * 4, pa.string()), strict=True)], names=fields)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pieces(path)
        for batch in batches:
            out = []
            for x in batch.itertuples(index=False):
                for a, b, w in Chunk(x.text, x.offset, x.begin, x.end, x.total, model).matrix():
                    out.append((x.key, x.no, *(a or (-1, -1)), *b, w))
            yield pd.DataFrame(out, columns=["key", "no", "from_start", "from_end", "to_start", "to_end", "weight"])

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        by = [[] for _ in range(int(group["no"].max()) + 1)]
        for x in group.itertuples(index=False):
            by[x.no].append((None if x.from_start < 0 else (x.from_start, x.from_end), (x.to_start, x.to_end), x.weight))
        states = boundary_states(by)
        return pd.DataFrame([(group["key"].iloc[0], k, *(a or (-1, -1)), *b) for k, (a, b) in enumerate(zip(states, states[1:], strict=False))], columns=["key", "no", "from_start", "from_end", "to_start", "to_end"])

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pieces(path)
        for batch in batches:
            ids = [Chunk(x.text, x.offset, x.begin, x.end, x.total, model).trace(None if x.from_start < 0 else (x.from_start, x.from_end), (x.to_start, x.to_end)) for x in batch.itertuples(index=False)]
            yield pd.DataFrame({"key": batch["key"], "no": batch["no"], "ids": ids})

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(path).library
        for batch in batches:
            same = [hashlib.sha256(library.decode(ids).encode()).hexdigest() == key for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same)], names=["key", "token_ids", "exact"])

    # A text may have any length, so a row of it is held by one task at a time; its chunks are not.
    once = rows.groupBy("key").agg(F.first("text").alias("text"))
    chunks = stored(once.mapInArrow(cut_rows, "key string, no int, offset long, begin long, end long, total long, text string").repartition("key", "no"), "giant-chunks")
    states = chunks.mapInPandas(matrices, f"{entry}, weight long").groupBy("key").applyInPandas(scan, entry)  # a few small rows a chunk
    parts = chunks.join(states, ["key", "no"]).mapInPandas(traced, "key string, no int, ids array<int>")
    whole = parts.groupBy("key").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("no", "ids"))), lambda x: x["ids"])).alias("token_ids"))
    whole = whole.mapInArrow(checked, "key string, token_ids array<int>, exact boolean")
    return rows.select("id", "key").join(whole, "key").select("id", "token_ids", "exact")


def decoded(tokens: DataFrame, id_col: str = "doc_id", tokens_col: str = "token_ids", path: str = MODEL) -> DataFrame:
    """Per row: id and text; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(path).library
        for batch in batches:
            texts = [library.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return tokens.select(id_col, tokens_col).mapInArrow(run, f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, text string")
