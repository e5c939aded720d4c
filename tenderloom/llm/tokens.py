"""Token ids of whole text columns through the tokenizers library.

A vocabulary with word ends that drops white space treats each word on its own, so the library is asked once for each
distinct word of a slice and the ids are put together by index. Texts that spell a special token, and other kinds of
vocabulary, are encoded whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tenderloom.llm.common import split_words

WORD_BPE = "word_bpe_49k.json"
# Latin letters but the one whose lower case ends in a combining dot, which joins the punctuation.
LETTER_THEN_MARK = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([.,;:!?])"
# Lower-case letters of Latin-1: composed already, and one piece for the splitter.
PLAIN_WORD = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{FF}]+$"
# Distinct words kept between slices by one Python worker; only speed depends on it.
CACHED_WORDS = 300_000
_LOADED: dict[str, TextEncoder] = {}


def resolve(name: str) -> str:
    """A path stays; a bare name is looked up beside the installed public tokenizers, on the machine that asks."""
    if os.path.dirname(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(name: str) -> TextEncoder:
    if name not in _LOADED:
        _LOADED[name] = TextEncoder(resolve(name))
    return _LOADED[name]


def byte_letters() -> list[str]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 as is, others from U+0100 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class TextEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word = getattr(self.model, "end_of_word_suffix", None) == "</w>"
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.specials = "|".join("".join(f"\\x{{{ord(c):x}}}" for c in t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.cache: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """Ids of one word. Words of ASCII or Latin letters are a single piece for the model; others go through the library's splitter."""
        if word.isascii():
            plain = word.isalpha()
        else:
            word = unicodedata.normalize("NFC", word)
            plain = word.isalpha() and all(c < "ɐ" and c != "İ" for c in word)
        if plain:
            tokens = self.model.tokenize(word.lower().encode().decode("latin-1").translate(self.letters))
            return np.array([t.id for t in tokens], np.uint32).tobytes()
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _fresh(self, words: pa.Array) -> list[bytes]:
        """Ids of each word. Plain lower-case words, nearly all, are spelled in one go; the others one by one."""
        plain = pc.match_substring_regex(words, PLAIN_WORD).to_numpy(zero_copy_only=False)
        found: list[bytes] = [b""] * len(words)
        easy = np.flatnonzero(plain)
        if len(easy):
            spelled = "\n".join(words.take(pa.array(easy)).to_numpy(zero_copy_only=False)).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
            tokenize = self.model.tokenize
            flat, ends = [], [0]
            for w in spelled:
                flat += [t.id for t in tokenize(w)]
                ends.append(4 * len(flat))
            flat = np.array(flat, np.uint32).tobytes()
            for i, first, last in zip(easy.tolist(), ends, ends[1:]):
                found[i] = flat[first:last]
        rest = np.flatnonzero(~plain)
        for i, w in zip(rest.tolist(), words.take(pa.array(rest)).to_numpy(zero_copy_only=False)):
            found[i] = self._word(w)
        return found

    def _words(self, words: pa.Array, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and their offsets. Words of several uses are kept for later slices."""
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        listed = words.to_numpy(zero_copy_only=False).tolist()
        found = list(map(cache.get, listed))
        again = (uses > 1).tolist()
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self._fresh(words.take(pa.array(missing, pa.int64())))):
            found[i] = ids
            if again[i] and len(listed[i]) <= 32:
                cache[listed[i]] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), np.concatenate([[0], np.cumsum(sizes)])

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of the texts; null counts as empty.
        ``end_id`` closes each text."""
        texts = texts.fill_null("")
        n = len(texts)
        apart = np.ones(n, bool)
        if self.by_word:
            apart = np.zeros(n, bool)
            if self.specials:
                apart = pc.match_substring_regex(texts, f"(?i){self.specials}").to_numpy(zero_copy_only=False)
        alone = {int(i): ids for i, ids in zip(np.flatnonzero(apart), self.whole(texts.filter(pa.array(apart)).to_pylist()))}
        rest = texts if not alone else pc.if_else(pa.array(apart), "", texts)
        # the splitter parts letters from the punctuation behind them in any case; this makes fewer distinct words
        rest = pc.ascii_lower(pc.replace_substring_regex(rest, LETTER_THEN_MARK, r"\1 \2"))
        codes, words, bounds = split_words(rest)
        flat, starts = self._words(words, np.bincount(codes, minlength=len(words)))
        sizes = np.diff(starts)[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        per_text = np.diff(ends[bounds])
        for i, ids in alone.items():
            per_text[i] = len(ids)
        tail = 0 if end_id is None else 1
        offsets = np.concatenate([[0], np.cumsum(per_text + tail)])
        out = np.empty(offsets[-1], np.uint32)
        # a word's first id goes to: ids before it, end ids before it, ids of texts encoded whole before it
        if len(codes):
            shift = np.repeat(offsets[:-1] - ends[bounds[:-1]], np.diff(bounds))
            to = ends[:-1] + shift
            spread = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
            out[np.repeat(to, sizes) + spread] = flat[np.repeat(starts[:-1][codes], sizes) + spread]
        for i, ids in alone.items():
            out[offsets[i]:offsets[i] + len(ids)] = ids
        if tail:
            out[offsets[1:] - 1] = end_id
        return out, offsets
