"""Texts to token ids with a vocabulary file whose path is a parameter, in Arrow batches of bounded size."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallywake.llm.common import column_bytes, of_process, sliced

# Words whose ids a process keeps (it starts anew beyond that, which changes no result), and bytes of those it does.
WORDS, LONGEST = 1 << 19, 64
# New words are encoded so many at a time, with this between them.
TOGETHER, BETWEEN = 512, "|"
# A word of letters of ASCII and Latin-1, with ASCII marks after them or not.
PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-/:-@\[-`{-~]*)")
# The normalizer and pre-tokenizer by which such a word's ids are those of its letters in lower case and those of its marks.
LOWERS = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PARTS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _plain(vocab: str) -> bool:
    """Whether the vocabulary takes words of PLAIN as their letters and their marks, and none of its added tokens is in one."""
    with open(vocab, encoding="utf-8") as file:
        parts = json.load(file)
    return parts["normalizer"] == LOWERS and parts["pre_tokenizer"] == PARTS and all(
        re.search(rb"[!-/:-@\[-`{-~][A-Za-z]", t["content"].encode()) for t in parts["added_tokens"])


class Known(dict):
    """Ids by word. What is missing and plain is put together from the model's ids of its letters, of which there are fewer than
    words; what is not plain is None and in `late`."""

    def __init__(self, tokenizer, plain: bool) -> None:
        from tokenizers import pre_tokenizers

        super().__init__()
        self.tokenizer, self.model, self.plain = tokenizer, tokenizer.model, plain
        self.late: set[bytes] = set()
        self.long: list[bytes] = []
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def __missing__(self, word: bytes) -> bytes | None:
        match = PLAIN.fullmatch(word.decode()) if self.plain else None
        if not match:
            self.late.add(word)
            return None
        letters, marks = match.groups()
        lower = letters.lower()
        if marks or lower != letters:
            ids = self[lower.encode()]
            if marks:
                ids += self.of_marks(marks)
        else:
            found = self.model.tokenize(lower if word.isascii() else lower.translate(self.letters))
            ids = struct.pack(f"<{len(found)}I", *(t.id for t in found))
        self.put(word, ids)
        return ids

    def of_marks(self, marks: str) -> bytes:
        key = marks.encode()
        if key not in self:
            self.put(key, np.array(self.tokenizer.encode(marks, add_special_tokens=False).ids, "<u4").tobytes())
        return self[key]

    def put(self, word: bytes, ids: bytes) -> None:
        self[word] = ids
        if len(word) > LONGEST:
            self.long.append(word)

    def forget(self) -> None:
        """Drop the long words, and all where there are many."""
        for word in self.long:
            self.pop(word, None)
        self.long = []
        if len(self) > WORDS:
            self.clear()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, put together from those of their words.

    For vocabularies that drop white space and let no token reach across it, so that the ids of a text are those of the words between
    ASCII white space. A word is encoded when it first comes to the process.
    """

    def __init__(self, vocab: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocab)
        self.known = Known(self.tokenizer, _plain(vocab))
        mark = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words. Those with the mark in them go alone, the others many at a time, with the mark between."""
        alone = [w for w in words if self.mark is None or BETWEEN.encode() in w]
        found = dict(zip(alone, (np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(
            [w.decode() for w in alone], add_special_tokens=False))))
        rest = [w for w in words if w not in found]
        lots = [rest[lo:lo + TOGETHER] for lo in range(0, len(rest), TOGETHER)]
        texts = [f" {BETWEEN} ".join(w.decode() for w in lot) for lot in lots]
        for lot, e in zip(lots, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark).tolist()
            whole = ids.tobytes()
            for word, lo, hi in zip(lot, [0, *(4 * (at + 1) for at in ends)], [*(4 * at for at in ends), len(whole)]):
                found[word] = whole[lo:hi]
        return [found[w] for w in words]

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        split = [t.split() if t else [] for t in texts]
        found = [list(map(self.known.__getitem__, words)) for words in split]
        if self.known.late:
            late = list(self.known.late)
            for word, ids in zip(late, self._words(late)):
                self.known.put(word, ids)
            self.known.late.clear()
            found = [list(map(self.known.__getitem__, words)) if None in own else own for own, words in zip(found, split)]
        joined = [b"".join(own) for own in found]
        self.known.forget()
        return joined


def encoded(batches: Iterator[pa.RecordBatch], text: str, vocab: str, end: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch, cut to about a megabyte of text, with the ids of its texts (null: empty), `end` appended to each."""
    encoder = of_process(("encoder", vocab), lambda: Encoder(vocab))
    last = np.array([end], "<u4").tobytes()
    for batch in sliced(batches, text, 1 << 20):
        yield batch, [np.frombuffer(ids + last, "<u4") for ids in encoder.ids(column_bytes(batch, text))]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())
