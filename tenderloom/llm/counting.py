"""Token counts of whole texts by deterministic transducers compiled from a byte-level BPE vocabulary.

The first transducer reads character classes and marks where the pieces begin that the vocabulary's splitter would cut. Texts are cut into chunks of
``CHUNK`` characters; each chunk's map from every entry state to its exit state is computed with all chunks side by side, the maps are composed
by a parallel prefix scan, and a second walk with the known entry states marks the pieces. The second transducer reads a piece's bytes. Its state holds, for
every suffix that may still grow into a token, the last token before it and how many tokens fewer it stands at; a transition says by how much the number of
tokens changes. States are compiled when first met. A text's count is the sum over its pieces, each distinct piece being run once per slice.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tenderloom.llm.common import buffer_of, slices, string_array
from tenderloom.llm.tokens import byte_letters, resolve

BYTE_BPE = "byte_bpe_50k.json"
CHUNK, MEETING = 128, 16
# States and pieces kept by one Python worker; beyond, they are compiled anew. Only speed depends on it.
MOST_STATES, MOST_PIECES = 150_000, 200_000
NEW = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}

# Character classes; the letters and the apostrophe are those of the splitter's contractions 's 't 'm 'd 're 've 'll.
END, LETTER, ONE, R_V, L, E, NUMBER, SPACE, WHITE, APOSTROPHE, OTHER = range(11)
# States: at the start of a piece; in letters, numbers, other signs; behind an apostrophe that began a piece, and behind its r or v, or its l; in
# white space of one sign (a space or another), of several (the last a space or another).
START, LETTERS, NUMBERS, SIGNS, APOS, APOS_E, APOS_L, SPACE1, WHITE1, SPACE2, WHITE2 = range(11)
HERE, BEFORE = 1, 2      # a piece begins at this character, at the one before


def _step(state: int, kind: int) -> tuple[int, int]:
    letter = kind in (LETTER, ONE, R_V, L, E)
    fresh = LETTERS if letter else {NUMBER: NUMBERS, SPACE: SPACE1, WHITE: WHITE1, APOSTROPHE: APOS, OTHER: SIGNS}.get(kind, START)
    joined = LETTERS if letter else NUMBERS if kind == NUMBER else SIGNS
    if kind == END:
        return START, BEFORE if state in (APOS_E, APOS_L) else 0
    if state in (SPACE1, WHITE1, SPACE2, WHITE2):
        if kind in (SPACE, WHITE):
            return (SPACE2 if kind == SPACE else WHITE2), 0
        cut = BEFORE if state in (SPACE2, WHITE2) else 0       # the run gives up its last sign
        return (joined, cut) if state in (SPACE1, SPACE2) else (fresh, cut | HERE)
    if state == APOS:
        if kind == ONE:
            return START, 0
        if kind in (R_V, L):
            return (APOS_E if kind == R_V else APOS_L), 0
        return (SIGNS, 0) if kind in (APOSTROPHE, OTHER) else (fresh, HERE)
    if state in (APOS_E, APOS_L):
        if kind == (E if state == APOS_E else L):
            return START, 0
        return (LETTERS, BEFORE) if letter else (fresh, BEFORE | HERE)      # the apostrophe stood alone
    same = {LETTERS: letter, NUMBERS: kind == NUMBER, SIGNS: kind in (APOSTROPHE, OTHER)}.get(state, False)
    return (state, 0) if same else (fresh, HERE)


def _classes() -> np.ndarray:
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for run in regex.finditer(pattern, every):
            first, last = ord(run[0][0]), ord(run[0][-1])
            out[first:last + 1] = kind
    out[0xD800:0xE000] = OTHER
    for c, kind in {" ": SPACE, "'": APOSTROPHE, "s": ONE, "t": ONE, "m": ONE, "d": ONE, "r": R_V, "v": R_V, "l": L, "e": E}.items():
        out[ord(c)] = kind
    return out


class Splitter:
    """The first transducer."""

    def __init__(self) -> None:
        self.classes = _classes()
        table = [[_step(q, c) for q in range(11)] for c in range(11)]
        self.next = np.array([[t[0] for t in row] for row in table], np.uint8)
        self.flags = np.array([[t[1] for t in row] for row in table], np.uint8)

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions where pieces begin in the texts data[offsets[i]:offsets[i + 1]]."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        kinds = self.classes[_code_points(data, lead)]
        first = np.searchsorted(lead, offsets)                  # a text's first character
        at = np.arange(len(lead)) + np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        length = len(lead) + len(offsets) - 1                  # an end mark behind each text
        chunks = -(-length // CHUNK) or 1
        line = np.full(chunks * CHUNK, END, np.uint8)
        line[at] = kinds
        flags = self._walk(line.reshape(chunks, CHUNK))
        flags[:-1] |= (flags[1:] & BEFORE) >> 1
        return lead[(flags[at] & HERE) > 0]

    def _walk(self, line: np.ndarray) -> np.ndarray:
        chunks, q = len(line), len(self.next)
        table, rows = self.next.ravel(), line.T.astype(np.int16) * q
        maps = np.broadcast_to(np.arange(q, dtype=np.int16), (chunks, q))
        for t in range(MEETING):
            maps = table[rows[t, :, None] + maps].astype(np.int16)
        # by now nearly all chunks are in one state whatever they began with; those go on as one lane
        met = (maps == maps[:, :1]).all(axis=1)
        one, all_, some, others = maps[met, 0], maps[~met], rows[MEETING:, met], rows[MEETING:, ~met]
        for t in range(CHUNK - MEETING):
            one = table[some[t] + one].astype(np.int16)
            all_ = table[others[t, :, None] + all_].astype(np.int16)
        maps = maps.copy()
        maps[met], maps[~met] = one[:, None], all_
        reach, step = maps.astype(np.intp), 1
        while step < chunks:        # the map of chunks 0 to i, for all i
            reach[step:] = np.take_along_axis(reach[step:], reach[:-step].copy(), axis=1)
            step *= 2
        state = np.concatenate([[START], reach[:-1, START]]).astype(np.int16)
        flags = np.empty(line.T.shape, np.uint8)
        marks = self.flags.ravel()
        for t in range(CHUNK):
            index = rows[t] + state
            flags[t] = marks[index]
            state = table[index]
        return flags.T.ravel()


def _code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    first = data[lead].astype(np.int32)
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        b = [padded[lead[wide] + j].astype(np.int32) & 0x3F for j in range(4)]
        head = first[wide]
        first[wide] = np.where(head < 0xE0, (head & 0x1F) << 6 | b[1], np.where(
            head < 0xF0, (head & 0x0F) << 12 | b[1] << 6 | b[2], (head & 0x07) << 18 | b[1] << 12 | b[2] << 6 | b[3]))
    return first


class Transducer:
    """The second: bytes of a piece to its number of tokens."""

    def __init__(self, vocabulary: dict[bytes, int], merges: dict[int, tuple[int, int]]) -> None:
        self.rank = {pair: rank for pair, (rank, _) in merges.items()}
        self.made = {joined: (rank, pair >> 32, pair & 0xFFFFFFFF) for pair, (rank, joined) in merges.items()}
        if len(self.made) != len(merges):
            raise ValueError("a token that two merges make")
        self.child: dict[int, int] = {}
        self.token = [-1]
        for word, number in vocabulary.items():
            node = 0
            for b in word:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node] = number
        self.inner = bytearray(len(self.token))
        for key in self.child:
            self.inner[key >> 8] = 1
        self.edges: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = (self._entry(0, 0, 0),)
        self.states, self.numbers = [start], {start: 0}
        self.moves: dict[int, int] = {}
        self.pieces: dict[bytes, int] = {}

    @staticmethod
    def _entry(node: int, last: int, less: int) -> int:
        """A suffix that may grow: its node, one more than the token before it (0: none), tokens there less those at the end."""
        return (node << 32 | last) << 16 | less + 32768

    def _edge(self, token: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """What stands at the token's left and right end while it is merged, each with the rank of the merge that takes it up."""
        found = self.edges.get(token)
        if found is None:
            sides = []
            for side in (1, 2):
                part, until, line = token, 1 << 40, []
                while True:
                    line.append((part, until))
                    if part not in self.made:
                        break
                    until, part = self.made[part][0], self.made[part][side]
                sides.append(line)
            found = self.edges[token] = tuple(sides)
        return found

    def _kept_apart(self, left: int, right: int, before: int) -> bool:
        """No merge over the seam comes before rank ``before`` while both its sides stand there; of equal ranks the left goes first."""
        rank = self.rank
        for x, x_until in self._edge(left)[1]:
            for y, y_until in self._edge(right)[0]:
                r = rank.get(x << 32 | y)
                if r is not None and r < x_until and r <= y_until and r < before:
                    return False
        return True

    def _whole(self, token: int) -> bool:
        """Whether the token's own bytes are merged to it."""
        key = -1 - token
        found = self.pairs.get(key)
        if found is None:
            rule = self.made.get(token)
            found = self.pairs[key] = rule is None or self._whole(rule[1]) and self._whole(rule[2]) and self._kept_apart(rule[1], rule[2], rule[0])
        return found

    def _stands(self, last: int, token: int) -> bool:
        """Whether the token may follow the one before it; ``last`` is one more than that, or 0."""
        key = last << 32 | token
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > 2 * MOST_STATES:
                self.pairs.clear()
            found = self.pairs[key] = self._whole(token) and (not last or self._kept_apart(last - 1, token, 1 << 40))
        return found

    def _compile(self, state: int, byte: int) -> int:
        child, tokens, inner = self.child, self.token, self.inner
        grown, token = [], None
        for entry in self.states[state]:
            node = child.get(entry >> 48 << 8 | byte)
            if node is None:
                continue
            last, less = entry >> 16 & 0xFFFFFFFF, (entry & 0xFFFF) - 32768
            if token is None and tokens[node] >= 0 and self._stands(last, tokens[node]):
                token, change = tokens[node], less + 1
            if inner[node]:
                grown.append((node, last, less))
        after = (*[self._entry(n, last, less - change) for n, last, less in grown], self._entry(0, token + 1, 0))
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        move = self.moves[state << 8 | byte] = number << 16 | change + 32768
        return move

    def count(self, piece: bytes) -> int:
        known = self.pieces.get(piece)
        if known is not None:
            return known
        if len(self.states) > MOST_STATES or len(self.pieces) > MOST_PIECES:
            self._reset()
        state, total, moves = 0, -32768 * len(piece), self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state = move >> 16
            total += move & 0xFFFF
        if len(piece) <= 32:
            self.pieces[piece] = total
        return total


class Counter:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, before = stated["model"], stated["pre_tokenizer"]
        if model["type"] != "BPE" or stated["normalizer"] or before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"]:
            raise ValueError("a byte-level BPE vocabulary without normalisation is needed")
        of = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"] for t in stated["added_tokens"]}
        raw = {w: i for w, i in model["vocab"].items() if w not in special}
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges[raw[a] << 32 | raw[b]] = rank, raw[a + b]
        self.transducer = Transducer({bytes(of[c] for c in w): i for w, i in raw.items()}, merges)
        self.splitter = Splitter()
        self.special = "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text. A special token's string is one token and parts the text."""
        texts = texts.fill_null("")
        extra = np.zeros(len(texts), np.int64)
        groups = np.arange(len(texts) + 1)
        if self.special and pc.any(pc.match_substring_regex(texts, self.special)).as_py():
            parts = pc.split_pattern_regex(texts, self.special)
            groups = parts.offsets.to_numpy().astype(np.int64)
            texts, extra = parts.flatten(), np.diff(groups) - 1
        data, offsets = buffer_of(texts)
        if not len(data):
            return extra
        starts = self.splitter.starts(data, offsets)
        coded = string_array(data, np.append(starts, len(data)), pa.binary()).dictionary_encode()
        sizes = np.fromiter(map(self.transducer.count, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        total = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy(zero_copy_only=False)])])
        at = total[np.searchsorted(starts, offsets)]
        return np.diff(at[groups]) + extra


_COUNTERS: dict[str, Counter] = {}


def count_tokens(df: DataFrame, tokenizer: str = BYTE_BPE, limit: int = 512, text_col: str = "text") -> DataFrame:
    """All rows and columns with n_bytes (UTF-8), n_tokens and over_limit (more tokens than ``limit``); columns of these names are replaced.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted alike; an empty table stays empty.
    """
    kept = df.drop(*NEW)
    schema = kept.selectExpr("*", *(f"cast(null as {t}) {n}" for n, t in NEW.items())).schema

    def run(batches):
        path = resolve(tokenizer)
        counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, Counter(path))
        for batch in slices(batches, text_col):
            texts = batch.column(text_col)
            n = counter.counts(texts)
            new = [pa.array(np.diff(buffer_of(texts)[1])), pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *NEW])

    return kept.mapInArrow(run, schema)
