"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton over the pieces' bytes drives one pass over a word: at each
byte it follows the output links from the current state, i.e. all pieces
that end here from the longest to the shortest, and relaxes the best score
at this position.  All distinct words of a block take the pass together, as
arrays.  Space becomes the mark U+2581.  Where no piece holds that mark inside,
the best path through a text is the best paths through its words; with other
vocabularies a text is one word.  Bytes that no piece covers, and a literal
U+2581, become byte pieces, so decoding gives back the text exactly.

Pieces of a unigram model have log probabilities.  Those of a BPE model have
ranks only, which don't add up along a path; by Zipf's law a piece of rank r
gets the log probability -log(1 + r), up to a constant.  Nothing is trained.
The best path is that of these scores, not the order of the model's merges.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import bound_batches
from .textarrays import separator_table, text_blocks, token_hashes

#: Name of the installed public model; any SentencePiece model with byte pieces will do.
DEFAULT_MODEL = "piece_bpe_32k.model"
MARK = "▁".encode()
#: What a byte piece costs more than the worst piece.
BYTE_PENALTY = 10.0
#: Tokens that are decoded together.
SLICE_TOKENS = 300_000
_SPACE = separator_table((0x20, 0x20))


def public_model(name: str = DEFAULT_MODEL) -> str:
    """Path of a model of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes with ids and scores, and the ids of the 256 byte pieces."""

    pieces: list[bytes]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, ids, scores = [], [], []
        byte_ids = np.full(256, -1, dtype=np.int32)
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append(model.id_to_piece(i).encode())
                ids.append(i)
                scores.append(model.get_score(i))
        if (byte_ids < 0).any():
            raise ValueError("the model has no piece for some bytes")
        return cls(pieces, np.array(ids, dtype=np.int32), log_probabilities(np.array(scores)), byte_ids)

    def spans_words(self) -> bool:
        """Whether a piece holds the mark inside, other than a run of marks."""
        return any(MARK in p[1:] and p.replace(MARK, b"") for p in self.pieces)


def log_probabilities(scores: np.ndarray) -> np.ndarray:
    """Scores as log probabilities: minus ranks, which are whole numbers, by Zipf's law; others as they are."""
    if len(scores) and (scores == np.round(scores)).all():
        return -np.log1p(np.clip(-scores, 0, len(scores)))
    return scores


@dataclass
class Automaton:
    """Goto table with failures resolved, and output links, over a reduced alphabet of bytes."""

    vocabulary: Vocabulary
    symbol: np.ndarray = field(init=False)
    step: np.ndarray = field(init=False)
    ends: np.ndarray = field(init=False)  # piece that ends in a state, or -1
    link: np.ndarray = field(init=False)  # next state on the way of failures in which a piece ends, or 0
    length: np.ndarray = field(init=False)
    whole: bool = field(init=False)  # texts aren't split into words

    def __post_init__(self) -> None:
        self.whole = self.vocabulary.spans_words()
        pieces = self.vocabulary.pieces
        used = sorted({b for p in pieces for b in p})
        self.symbol = np.zeros(256, dtype=np.int32)  # 0: a byte of no piece
        self.symbol[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for number, piece in enumerate(pieces):
            state = 0
            for b in piece:
                s = int(self.symbol[b])
                if s not in children[state]:
                    children[state][s] = len(children)
                    children.append({})
                    ends.append(-1)
                state = children[state][s]
            ends[state] = number
        self.ends = np.array(ends, dtype=np.int32)
        self.link = np.zeros(len(children), dtype=np.int32)
        self.step = np.zeros((len(children), width), dtype=np.int32)
        fail = np.zeros(len(children), dtype=np.int32)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            if state:
                self.step[state] = self.step[fail[state]]
                self.link[state] = fail[state] if self.ends[fail[state]] >= 0 else self.link[fail[state]]
            for s, child in children[state].items():
                fail[child] = self.step[state, s] if state else 0
                self.step[state, s] = child
                queue.append(child)
        self.length = np.array([len(p) for p in pieces], dtype=np.int32)

    def segment(self, words: np.ndarray, sizes: np.ndarray, literal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best paths of words given as rows of bytes (rows sorted by size, longest first).

        `literal` marks bytes that only byte pieces may cover.  Returns token
        ids and counts, word by word.
        """
        scores = self.vocabulary.scores
        worst = float(scores.min()) - BYTE_PENALTY if len(scores) else -BYTE_PENALTY
        n, width = words.shape
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0
        back = np.zeros((width + 1, n), dtype=np.int32)  # piece that ends here; -1: a byte
        state = np.zeros(n, dtype=np.int32)
        live = np.searchsorted(-sizes, -np.arange(1, width + 1), side="right")  # rows that reach each byte
        for t in range(width):
            m = int(live[t])
            symbols = np.where(literal[:m, t], 0, self.symbol[words[:m, t]])
            state[:m] = self.step[state[:m], symbols]
            value = best[t, :m] + worst
            piece = np.full(m, -1, dtype=np.int32)
            at = state[:m].copy()
            at = np.where(self.ends[at] >= 0, at, self.link[at])
            rows = np.flatnonzero(at)
            at = at[rows]
            while len(rows):
                p = self.ends[at]
                score = best[t + 1 - self.length[p], rows] + scores[p]
                better = score > value[rows]
                value[rows[better]] = score[better]
                piece[rows[better]] = p[better]
                at = self.link[at]
                on = at > 0
                rows, at = rows[on], at[on]
            best[t + 1, :m], back[t + 1, :m] = value, piece
        # Walk back from the ends, all words together.
        tokens = np.zeros((width, n), dtype=np.int32)
        counts = np.zeros(n, dtype=np.int64)
        position, rows = sizes.copy(), np.flatnonzero(sizes > 0)
        while len(rows):
            p = back[position[rows], rows]
            byte = p < 0
            previous = position[rows] - np.where(byte, 1, self.length[np.maximum(p, 0)])
            ids = np.where(byte, self.vocabulary.byte_ids[words[rows, position[rows] - 1]], self.vocabulary.ids[np.maximum(p, 0)])
            tokens[counts[rows], rows] = ids
            counts[rows] += 1
            position[rows] = previous
            rows = rows[previous > 0]
        offsets = np.concatenate(([0], np.cumsum(counts)))
        word = np.repeat(np.arange(n), counts)
        nth = counts[word] - 1 - (np.arange(offsets[-1]) - offsets[word])  # they were found from the end
        return tokens[nth, word], counts


_automata: dict[int, Automaton] = {}


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices starts[i] ... starts[i] + counts[i] - 1 for all i, one after the other."""
    total = int(counts.sum())
    before = np.concatenate(([0], np.cumsum(counts)))[:-1]
    return np.arange(total) + np.repeat(starts - before, counts)


def encode_block(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token ids, offsets) of the texts of a block.  A text that is not empty gets a space before it."""
    size = np.diff(offsets)
    full = size > 0
    # One leading space for each text; it and each inner space start a word, unless a space follows a space.
    shift = np.cumsum(full)
    raw = np.empty(len(data) + int(full.sum()), dtype=np.uint8)
    new_offsets = offsets + np.concatenate(([0], shift))
    row = np.repeat(np.arange(len(size)), size)
    raw[np.arange(len(data)) + shift[row]] = data
    raw[new_offsets[:-1][full]] = 32
    data, offsets = raw, new_offsets
    if not len(data):
        return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
    space = _SPACE[data]
    first = space & (not automaton.whole)
    first[1:] &= ~space[:-1]
    first[offsets[:-1][full]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(data))
    hashes = token_hashes(data, starts, ends, lower=False)
    _, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    # Distinct words, spaces written as the mark.
    a, b = starts[example], ends[example]
    lengths = b - a
    flat = data[_gather(a, lengths)]
    is_space = flat == 32
    literal = np.zeros(len(flat), dtype=bool)
    hit = (flat[:-2] == MARK[0]) & (flat[1:-1] == MARK[1]) & (flat[2:] == MARK[2]) if len(flat) > 2 else np.zeros(0, dtype=bool)
    for i in range(3):
        literal[i : len(flat) - 2 + i][hit] = True
    grown = np.where(is_space, 3, 1)
    before = np.concatenate(([0], np.cumsum(grown)))
    wide = np.repeat(flat, grown)
    wide_literal = np.repeat(literal, grown)
    at = before[:-1][is_space]
    for i in range(3):
        wide[at + i] = MARK[i]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    wide_bounds = before[bounds]
    sizes = np.diff(wide_bounds)
    order = np.argsort(-sizes, kind="stable")
    ids_of: list[np.ndarray] = []
    count_of = np.zeros(len(sizes), dtype=np.int64)
    rank = 0
    while rank < len(order):
        longest = int(sizes[order[rank]])
        rows = max(1, min(20_000, 2_000_000 // (longest + 1)))
        part = order[rank : rank + rows]
        matrix = np.zeros((len(part), longest), dtype=np.uint8)
        marks = np.zeros((len(part), longest), dtype=bool)
        index = _gather(wide_bounds[part], sizes[part])
        to_row = np.repeat(np.arange(len(part)), sizes[part])
        to_col = index - np.repeat(wide_bounds[part], sizes[part])
        matrix[to_row, to_col] = wide[index]
        marks[to_row, to_col] = wide_literal[index]
        ids, counts = automaton.segment(matrix, sizes[part], marks)
        ids_of.append(ids)
        count_of[part] = counts
        rank += len(part)
    ids = np.concatenate(ids_of)
    ordered = np.concatenate(([0], np.cumsum(count_of[order])))[:-1]
    start_of = np.empty(len(order), dtype=np.int64)
    start_of[order] = ordered
    tokens = ids[_gather(start_of[inverse], count_of[inverse])]
    word_bounds = np.concatenate(([0], np.cumsum(count_of[inverse])))
    return tokens, word_bounds[np.searchsorted(starts, offsets)]


def decode_block(vocabulary: Vocabulary, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of token lists: the inverse of encode_block."""
    size = int(max(vocabulary.ids.max(), vocabulary.byte_ids.max())) + 1
    parts = [b""] * size
    for i, piece in zip(vocabulary.ids.tolist(), vocabulary.pieces, strict=True):
        parts[i] = piece.replace(MARK, b" ")
    for value, i in enumerate(vocabulary.byte_ids.tolist()):
        parts[i] = bytes([value])
    table = np.frombuffer(b"".join(parts), dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    lengths = np.diff(bounds)[tokens] if len(tokens) else np.zeros(0, dtype=np.int64)
    data = table[_gather(bounds[tokens], lengths)] if len(tokens) else np.zeros(0, dtype=np.uint8)
    ends = np.concatenate(([0], np.cumsum(lengths)))[offsets]
    full = np.diff(ends) > 0
    keep = np.ones(len(data), dtype=bool)
    keep[ends[:-1][full]] = False  # the space before each text
    return data[keep], ends - np.concatenate(([0], np.cumsum(full)))


def _automaton(shared) -> Automaton:
    if shared.id not in _automata:  # once for each Python worker
        _automata.clear()
        _automata[shared.id] = Automaton(shared.value)
    return _automata[shared.id]


class _Shared:
    """A broadcast with a name of its own."""

    def __init__(self, spark: SparkSession, value: Vocabulary):
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def encode_texts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of each row.

    A null text gives null ids and n_tokens 0, an empty one an empty list;
    null ids and repeated rows are kept as they are, and an empty table gives
    none.  Other columns of `docs` are ignored.  `model_path` names a
    SentencePiece model, by default the installed public one.  The vocabulary
    that is broadcast has the size of the model, whatever the input.
    """
    bound_batches(docs.sparkSession)
    shared = _Shared(docs.sparkSession, Vocabulary.load(model_path or public_model()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared)
        for batch in batches:
            texts = batch.column("text")
            for first, end, data, offsets in text_blocks(texts):
                tokens, bounds = encode_block(automaton, data, offsets)
                missing = np.asarray(texts.slice(first, end - first).is_null())
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens), mask=pa.array(missing))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), pa.array(np.diff(bounds)), lists], names=["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>")


def token_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about SLICE_TOKENS tokens (or one row)."""
    for batch in batches:
        ends = np.cumsum(np.nan_to_num(np.asarray(batch.column("ids").value_lengths().fill_null(0), dtype=np.float64)))
        row = 0
        while row < len(batch):
            before = ends[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, side="right")))
            yield batch.slice(row, end - row)
            row = end


def decode_tokens(tokens: DataFrame, model_path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_tokens, ids) with the decoded `text` added: null ids give a null text."""
    bound_batches(tokens.sparkSession)
    shared = _Shared(tokens.sparkSession, Vocabulary.load(model_path or public_model()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in token_slices(batches):
            lists = batch.column("ids")
            filled = lists.fill_null([]) if lists.null_count else lists
            values = np.asarray(filled.flatten()).astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(np.asarray(filled.value_lengths(), dtype=np.int64))))
            data, ends = decode_block(shared.value, values, bounds)
            missing = np.asarray(lists.is_null())
            texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
            texts = pa.array([None if m else t for m, t in zip(missing, texts.to_pylist(), strict=True)], pa.string()) if missing.any() else texts.cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=["doc_id", "n_tokens", "ids", "text"])

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(decode, "doc_id long, n_tokens long, ids array<int>, text string")
