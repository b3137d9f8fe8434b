"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Pieces and scores come from a public model file. The trie holds the UTF-8 bytes of the pieces, with a blank in
place of the whitespace marker; so a blank in a text meets the marker, and the marker's own character in a text is
ordinary. The segmentation with the highest sum of log scores wins (of equal ones, the one whose last
pieces are longer). A character that no piece covers becomes its bytes. As usual, one blank is put before a text
that is not empty; decoding removes it. Decoding gives back exactly the text that was encoded.

The file at hand holds a merge vocabulary whose scores are negative ranks. These become log
probabilities by Zipf's law, which favours few frequent pieces; ``scores="log"`` takes the scores as they are.

Defined results: a null text gives null tokens, an empty text none. Repeated rows are encoded one by one; an
empty table gives an empty result; ids and other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.llm import texts as tx

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: what an uncovered character costs beyond the least likely piece
UNKNOWN_PENALTY = 10.0
#: segments remembered by a Python worker; beyond that it starts anew
REMEMBERED = 200_000


class Trie(NamedTuple):
    """Child of node ``s`` for byte ``c`` is ``base[s] + c`` if ``check`` there is ``s``; ``piece`` is -1 inside."""

    base: list[int]
    check: list[int]
    piece: list[int]


class Vocabulary(NamedTuple):
    pieces: list[bytes]
    scores: list[float]
    byte_ids: list[int]
    trie: Trie
    unknown: float
    segment: str


def double_array(keys: dict[bytes, int]) -> Trie:
    """Trie of the keys, all of them at least one byte long."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for key, number in keys.items():
        at = 0
        for byte in key:
            nxt = children[at].get(byte)
            if nxt is None:
                nxt = len(children)
                children[at][byte] = nxt
                children.append({})
                ends.append(-1)
            at = nxt
        ends[at] = number
    base, check, piece = [0] * 512, [-1] * 512, [-1] * 512
    check[0] = 0
    # nodes with one child fill gaps; those with several are placed behind one another; places below 257 are out of
    # reach for most bytes and stay free
    waiting, gap, behind = [(0, 0)], 257, 257
    while waiting:
        node, place = waiting.pop()
        piece[place] = ends[node]
        codes = sorted(children[node])
        if not codes:
            continue
        while gap < len(check) and check[gap] >= 0:
            gap += 1
        start = (gap if len(codes) == 1 else max(gap, behind)) - codes[0]
        while True:
            while start + 256 >= len(check):
                more = len(check)
                base += [0] * more
                check += [-1] * more
                piece += [-1] * more
            if all(check[start + c] < 0 for c in codes):
                break
            start += 1
        if len(codes) > 1:
            behind = start
        base[place] = start
        for c in codes:
            check[start + c] = place
            waiting.append((children[node][c], start + c))
    return Trie(base, check, piece)


def load(path: str = MODEL_FILE, scores: str = "ranks") -> Vocabulary:
    """Pieces, log scores and trie of a model file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    raw = [model.get_score(i) for i in range(n)]
    if scores == "ranks":
        raw = [-float(np.log(2.0 - s)) for s in raw]
        total = float(np.log(sum(np.exp(s) for s in raw)))
        raw = [s - total for s in raw]
    pieces, byte_ids, keys = [], [0] * 256, {}
    for i in range(n):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(text[3:-1], 16)
            byte_ids[value] = i
            pieces.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            pieces.append(text.replace(MARKER, " ").encode())
            keys[pieces[-1]] = i
    # texts can be cut where no piece reaches across: before a blank after something else, and around newlines
    cut = not any(re.search(r"[^ ] ", p.decode()) for p in keys)
    lines = not any(b"\n" in p for p in keys)
    segment = (r" *[^ \n]+| +|\n" if lines else r" *[^ ]+| +") if cut else r"(?s).+"
    least = min(raw[i] for i in keys.values())
    return Vocabulary(pieces, raw, byte_ids, double_array(keys), least - UNKNOWN_PENALTY, segment)


def best(vocabulary: Vocabulary, text: bytes) -> list[int]:
    """Piece numbers of the best segmentation."""
    base, check, piece = vocabulary.trie
    scores, n, limit = vocabulary.scores, len(text), len(vocabulary.trie.check)
    worst = float("-inf")
    value, origin, chosen = [worst] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    value[0] = 0.0
    for i in range(n):
        here = value[i]
        if here == worst:
            continue
        state, j = 0, i
        while j < n:
            nxt = base[state] + text[j]
            if nxt >= limit or check[nxt] != state or nxt == 0:
                break
            state, j = nxt, j + 1
            number = piece[state]
            if number >= 0 and here + scores[number] > value[j]:
                value[j], origin[j], chosen[j] = here + scores[number], i, number
        lead = text[i]
        end = i + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
        if here + vocabulary.unknown > value[end]:
            value[end], origin[end], chosen[end] = here + vocabulary.unknown, i, -1
    out, at = [], n
    while at > 0:
        start = origin[at]
        out += [chosen[at]] if chosen[at] >= 0 else [vocabulary.byte_ids[b] for b in reversed(text[start:at])]
        at = start
    return out[::-1]


#: bytes of the longest segments that are solved together; longer ones are solved one by one
TOGETHER_BYTES = 64
#: segments solved together
TOGETHER = 8_192


class Arrays(NamedTuple):
    """Trie, scores and bytes of the pieces as arrays."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    scores: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    byte_ids: np.ndarray


def arrays(vocabulary: Vocabulary) -> Arrays:
    base, check, piece = (np.array(x, np.int64) for x in vocabulary.trie)
    begin = np.concatenate([[0], np.cumsum([len(p) for p in vocabulary.pieces])])
    return Arrays(base, check, piece, np.array(vocabulary.scores, np.float64), np.frombuffer(b"".join(vocabulary.pieces), np.uint8), begin,
                  np.array(vocabulary.byte_ids, np.int32))


def best_of(vocabulary: Vocabulary, held: Arrays, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bool]:
    """Piece numbers of the best segmentations one after the other, how many each text has, and whether they decode to the texts.

    The steps of :func:`best` in the same order, each for all texts at once.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    n, width = len(texts), int(sizes.max(initial=0))
    inside = np.arange(width) < sizes[:, None]
    data = np.frombuffer(b"".join(texts), np.uint8)
    byte = np.zeros((width, n), np.int64)
    byte.T[inside] = data
    lead = np.select([byte < 0x80, byte < 0xE0, byte < 0xF0], [1, 2, 3], 4)
    value = np.full((width + 1, n), -np.inf)
    origin, chosen = np.zeros((width + 1, n), np.int64), np.full((width + 1, n), -1, np.int64)
    value[0] = 0.0

    def offer(at: np.ndarray, rows: np.ndarray, worth: np.ndarray, start: int, number: np.ndarray | int) -> None:
        better = worth > value[at, rows]
        at, rows = at[better], rows[better]
        value[at, rows], origin[at, rows] = worth[better], start
        chosen[at, rows] = number[better] if isinstance(number, np.ndarray) else number

    for i in range(width):
        reached = np.flatnonzero((sizes > i) & (value[i] > -np.inf))
        rows, state = reached, np.zeros(len(reached), np.int64)
        for j in range(i, width):
            nxt = held.base[state] + byte[j, rows]
            on = (sizes[rows] > j) & (nxt < len(held.check)) & (nxt != 0)
            on[on] = held.check[nxt[on]] == state[on]
            rows, state = rows[on], nxt[on]
            if not len(rows):
                break
            number = held.piece[state]
            ends = number >= 0
            to, number = rows[ends], number[ends]
            offer(np.full(len(to), j + 1), to, value[i, to] + held.scores[number], i, number)
        offer(i + lead[i, reached], reached, value[i, reached] + vocabulary.unknown, i, -1)
    # each piece at the place where it begins, and the bytes of uncovered characters at their own
    ids = np.full((n, width), -1, np.int64)
    rows, at = np.flatnonzero(sizes), sizes[sizes > 0]
    while len(rows):
        start, number = origin[at, rows], chosen[at, rows]
        whole = number >= 0
        ids[rows[whole], start[whole]] = number[whole]
        for k in range(4):
            loose = ~whole & (start + k < at)
            ids[rows[loose], start[loose] + k] = held.byte_ids[byte[start[loose] + k, rows[loose]]]
        rows, at = rows[start > 0], start[start > 0]
    found = ids >= 0
    out = ids[found]
    length = held.begin[out + 1] - held.begin[out]
    exact = int(length.sum()) == len(data)
    if exact:
        # where each piece's bytes begin among all, and so each byte's place in the pieces
        place = np.arange(len(data)) + np.repeat(held.begin[out] - (np.cumsum(length) - length), length)
        exact = bool((held.data[place] == data).all())
    return out.astype(np.int32), found.sum(axis=1), exact


class Encoder:
    """Encodes texts, remembering the segments met lately; the new segments of several texts are solved together.

    A segment is decoded when it is solved. As long as every one came back byte by byte, so did the texts made of them;
    once one did not, texts are decoded as a whole.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, arrays(vocabulary)
        self.segments = re.compile(vocabulary.segment).findall
        self.known: dict[str, bytes] = {}
        self.all_exact = True

    def _solved(self, segment: str) -> bytes:
        text = segment.encode()
        ids = best(self.vocabulary, text)
        self.all_exact &= b"".join([self.vocabulary.pieces[i] for i in ids]) == text
        return np.array(ids, np.int32).tobytes()

    def _learn(self, segments: set[str]) -> list[str]:
        """Remember the piece numbers of segments that are not known yet; returns those too long to be kept."""
        short, texts, long = [], [], []
        for segment in segments:
            text = segment.encode()
            if len(text) <= TOGETHER_BYTES:
                short.append(segment)
                texts.append(text)
            else:
                self.known[segment] = self._solved(segment)
                long.append(segment)
        # of like lengths together
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        for k in range(0, len(order), TOGETHER):
            part = order[k : k + TOGETHER]
            ids, number, exact = best_of(self.vocabulary, self.held, [texts[i] for i in part])
            self.all_exact &= exact
            found, ends = ids.tobytes(), (4 * np.cumsum(number)).tolist()
            for i, f, t in zip(part, [0, *ends], ends):
                self.known[short[i]] = found[f:t]
        return long

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """Piece numbers of each text as 32-bit numbers; null for null."""
        segments = [self.segments(" " + t) if t else [] for t in texts]
        long = self._learn(set().union(*segments).difference(self.known))
        get = self.known.__getitem__
        out = [None if t is None else b"".join(map(get, s)) for t, s in zip(texts, segments)]
        for segment in long:
            del self.known[segment]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        return out

    def encode(self, text: str) -> bytes:
        """Piece numbers as 32-bit numbers."""
        return self.encode_all([text])[0]

    def comes_back(self, text: str, ids: np.ndarray) -> bool:
        """Whether decoding gives the text, for a text this encoder has encoded."""
        return self.all_exact or self.decode(ids) == text

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece numbers."""
        pieces = self.vocabulary.pieces
        text = b"".join([pieces[i] for i in ids.tolist()])
        return (text[1:] if text.startswith(b" ") else text).decode("utf-8", errors="replace")


_encoders: dict[str, object] = {}


def _encoder(sent) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    if sent.value is not _encoders.get("vocabulary"):
        _encoders["vocabulary"], _encoders["encoder"] = sent.value, Encoder(sent.value)
    return _encoders["encoder"]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """The rows with ``tokens``, ``n_tokens`` and ``exact`` (decoding gives the text back) in place of any columns of these names."""
    rows = docs.drop("tokens", "n_tokens", "exact")
    sent, at = docs.sparkSession.sparkContext.broadcast(vocabulary), rows.columns.index(text_col)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(sent)
        for batch in batches:
            for part in tx.chunks(batch, at):
                texts = part.column(at).to_pylist()
                ids = [None if t is None else np.frombuffer(t, np.int32) for t in coder.encode_all(texts)]
                lengths = np.array([0 if i is None else len(i) for i in ids], np.int64)
                nulls = pa.array([i is None for i in ids], pa.bool_())
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                values = np.concatenate([np.zeros(0, np.int32), *[i for i in ids if i is not None]])
                tokens = pa.ListArray.from_arrays(offsets, pa.array(values), mask=nulls)
                exact = [None if t is None else coder.comes_back(t, i) for t, i in zip(texts, ids)]
                number = pa.array(lengths, mask=nulls.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, tokens, number, pa.array(exact, pa.bool_())],
                                                 [*part.schema.names, "tokens", "n_tokens", "exact"])

    schema = rows.limit(0).select("*", F.lit(None).cast("array<int>").alias("tokens"), F.lit(None).cast("long").alias("n_tokens"), F.lit(None).cast("boolean").alias("exact")).schema
    return rows.mapInArrow(encoded, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, tokens_col: str = "tokens") -> DataFrame:
    """The rows with ``decoded``, the text of their tokens."""
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def decoded(tokens):  # noqa: ANN001, ANN202
        coder = _encoder(sent)
        return tokens.map(lambda ids: None if ids is None else coder.decode(ids))

    return rows.withColumn("decoded", decoded(F.col(tokens_col)))
