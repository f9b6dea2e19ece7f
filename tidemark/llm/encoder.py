"""Token ids of whole texts, with a cache of the chunks between blanks.

A byte-level or word-level BPE never joins characters over a blank that stands between two words, so a text can be
cut before every such blank and each distinct chunk is encoded once. Where blanks follow each other the cut would
change the result; such a text is encoded in one go. A byte-level BPE takes a line break between other characters as
a unit of its own, so texts are cut before those as well: a word that ends a line and the one that opens the next are
two chunks. Of new chunks, words of letters are given to the model of the byte-level tokenizer one by one, spelt as its
bytes, since nothing before the model changes or cuts them; others are encoded many at a time where what each id stands
for shows their ends. The cache has two generations of bounded size, so its memory is fixed; it only saves time.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute

from .common import trim

BLANKS = re.compile(r" (?<=\s )\s")
LINES = re.compile(r"\n(?:(?<=\s\n)|[^\S ])")  # breaks next to other blanks than one after them
PLAIN_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+[.,!?]?")
LINE_WORD = re.compile(r"[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+[.,!?]?")
_OPEN: dict[str, Encoder] = {}


def encoder(path: str, entries: int = 300_000) -> Encoder:
    """The encoder of a tokenizer file, one per Python worker; a generation of its cache has ``entries`` chunks."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path, entries)
        trim()  # what reading the file and earlier operators left
    _OPEN[path].entries = entries
    return _OPEN[path]


class Encoder:
    def __init__(self, path: str, entries: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True  # their strings in a text are ordinary text
        self.vocab = self.plain.get_vocab()
        self.dtype = np.dtype("<u2") if max(self.vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.entries = entries
        self.spelt: dict[int, str] = {}
        if any(token.endswith("</w>") for token in self.vocab):
            # Units are words and runs of marks, which end with a token of their own kind.
            self.units = np.zeros(max(self.vocab.values()) + 1, np.int64)
            self.units[[i for token, i in self.vocab.items() if token.endswith("</w>")]] = 1
            self.lines, self.word = False, PLAIN_WORD.fullmatch
            self.joinable, self.sizes = self.word, lambda chunks: [1 + (chunk[-1] in ".,!?") for chunk in chunks]
        else:
            # Units are bytes of text.
            self.units = self.token_bytes()
            self.lines, self.word = True, LINE_WORD.fullmatch
            self.joinable = re.compile(r"[ \n]\S(?s:.*\S)?").fullmatch
            self.sizes = lambda chunks: [len(raw) for raw in map(str.encode, chunks)]
            if self.plain.normalizer is None:
                bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
                self.spelt = {ord(c): bytes_of(c)[0][0] for c in " " + "".join(map(chr, range(0xC0, 0x100)))}
                self.line = self.plain.encode("\n", add_special_tokens=False).ids
        self.marks = {m: self._ids(m) for m in ".,!?"}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def token_bytes(self) -> np.ndarray:
        """Bytes of text behind each id of a byte-level vocabulary, where one character stands for a byte."""
        out = np.zeros(max(self.vocab.values()) + 1, np.int64)
        for token, i in self.vocab.items():
            out[i] = len(token)
        for i, t in self.plain.get_added_tokens_decoder().items():
            out[i] = len(t.content.encode())
        return out

    def _ids(self, text: str) -> bytes:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of chunks into the cache, from the older generation, from the word without its mark, or the tokenizer."""
        words, together, alone, marked, asked = [], [], [], [], set(chunks)
        new, old, marks, word, joinable, spelt = self.new, self.old, self.marks, self.word, self.joinable, self.spelt
        for chunk in chunks:
            known = old.get(chunk)
            if known is not None:
                new[chunk] = known
                continue
            letters = word(chunk)
            if letters and chunk[-1] in marks:
                # Letters and the mark after them are encoded apart.
                marked.append(chunk)
                chunk = chunk[:-1]
                if chunk in new or chunk in asked:
                    continue
                known = old.get(chunk)
                if known is not None:
                    new[chunk] = known
                    continue
                new[chunk] = b""  # taken, its ids follow
            if letters and spelt:
                words.append(chunk)
            elif letters or joinable(chunk):
                together.append(chunk)
            else:
                alone.append(chunk)
        for chunk, found in zip(alone, self.plain.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.new[chunk] = np.array(found.ids, self.dtype).tobytes()
        size = self.dtype.itemsize
        if words:
            self._learn_words(words)
        for at in range(0, len(together), 256):
            part = together[at : at + 256]
            (found,) = self.plain.encode_batch_fast(["".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            # Every id stands for a number of units, and so does every chunk: their running sums meet at the ends.
            ends = np.searchsorted(np.cumsum(self.units[ids]), np.cumsum(self.sizes(part)), "left") + 1
            raw, at_byte = ids.tobytes(), 0
            for chunk, end in zip(part, (ends * size).tolist(), strict=True):
                new[chunk] = raw[at_byte:end]
                at_byte = end
        for chunk in marked:
            new[chunk] = new[chunk[:-1]] + marks[chunk[-1]]

    def _learn_words(self, words: list[str]) -> None:
        """Put the ids of chunks of one blank or line break and letters into the cache."""
        tokenize, blank, spelt, line = self.plain.model.tokenize, self.spelt[ord(" ")], self.spelt, self.line
        ids: list[int] = []
        ends = [0]
        for chunk in words:
            letters = chunk[1:] if chunk.isascii() else chunk[1:].translate(spelt)
            if chunk[0] == " ":
                letters = blank + letters
            else:
                ids += line
            ids += [token.id for token in tokenize(letters)]
            ends.append(len(ids))
        raw, size, new = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize, self.new
        for chunk, a, b in zip(words, ends, ends[1:], strict=False):
            new[chunk] = raw[a * size : b * size]

    def encode(self, texts: list[str | None], step: int = 400) -> list[bytes]:
        """Ids of each text as little-endian integers of ``self.dtype``; a null counts as empty."""
        out: list[bytes] = []
        for at in range(0, len(texts), step):
            if len(self.new) > self.entries:
                self.old, self.new = self.new, {}
            cuts, whole = [], {}
            for k, text in enumerate(texts[at : at + step]):
                if not text or "\0" in text or BLANKS.search(text):
                    if text:
                        whole[k] = self._ids(text)
                    cuts.append("")
                    continue
                cut = text.replace(" ", "\0 ")
                if self.lines and "\n" in text and not LINES.search(text):
                    cut = cut.replace("\n", "\0\n")
                cuts.append(cut)
            kind = pa.string() if sum(map(len, cuts)) < 1 << 28 else pa.large_string()
            chunks = pa.compute.split_pattern(pa.array(cuts, kind), "\0")
            # The cache is asked once per distinct chunk of a step; their ids are laid out by place.
            coded = chunks.values.dictionary_encode()
            names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            found = list(map(self.new.get, names))
            holes = [k for k, x in enumerate(found) if x is None]
            if holes:
                self._learn([names[k] for k in holes])
                for k in holes:
                    found[k] = self.new[names[k]]
            laid = pa.array(found, pa.large_binary()).take(coded.indices)
            raw = memoryview(laid.buffers()[2] or b"")
            ends = np.frombuffer(laid.buffers()[1], np.int64)[chunks.offsets.to_numpy()].tolist()
            out += [whole.get(k) or raw[a:b].tobytes() for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
        return out
