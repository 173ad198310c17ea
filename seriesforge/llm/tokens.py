"""Token ids of whole texts by a public tokenizer file.

Texts repeat their words, so ids are kept per word. For the BPE files with word ends that keeps
the file's own result as long as normalising and splitting never look across white space, which
holds for printable Latin text; any other word, and any text with control or special strings,
goes through the tokenizer itself. Words are merged by the rank of the merged piece: ids ascend
with the order of merges in these files, which `Ids` checks when it opens one.

A batch of texts is worked on as a whole: its different words are found by Arrow, lowered and cut
together, and their different parts merged in one call. Nothing of that is kept for the next batch.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PLAIN = re.compile(r"[!-~¡-įı-ɏ]+\Z")
ODD = re.compile(r"[\x1c-\x1f]|<\|")
END_BYTE = b"\0"  # no plain word has it: it stands for the end of a word
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, DIGIT = 1, 2


def byte_letters() -> dict[str, int]:
    """Byte-level files write bytes as letters: printable ones as themselves, the others from code point 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Ids(dict):
    """Word to its ids, packed as little-endian 16-bit numbers; about so many words are kept, 40 MB.

    Words come in two generations: when the new one is full it becomes the old one, and a word that is
    met again moves to the new one. So frequent words stay, however many there are that occur once.
    """

    def __init__(self, path: str, most: int = 100_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.most, self.parts, self.old = most // 2, {}, {}
        self.packers = [struct.Struct(f"<{n}H").pack for n in range(64)]
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocabulary, suffix = told["model"]["vocab"], told["model"].get("end_of_word_suffix")
        self.size = self.whole.get_vocab_size()
        if self.size > 65_536:
            raise ValueError("ids must fit in 16 bits")
        merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
        first = len(vocabulary) - len(merges)
        self.piece, self.plain_split = None, False
        if suffix and all(vocabulary.get(a + b) == first + k for k, (a, b) in enumerate(merges)):
            self._open_ranks(vocabulary, suffix, told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def _open_ranks(self, vocabulary: dict[str, int], suffix: str, pattern: str) -> None:
        import regex
        import tiktoken

        letters = byte_letters()
        ranks = {}
        for token, rank in vocabulary.items():
            ended = token.endswith(suffix)
            body = token[: -len(suffix)] if ended else token
            if all(c in letters for c in body):
                ranks[bytes(letters[c] for c in body) + END_BYTE * ended] = rank
        self.split = regex.compile(pattern)
        self.ends_marked = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.piece = self.ends_marked._core_bpe.encode_single_piece
        self.plain_split = pattern == SPLIT
        self.ended = np.zeros(self.size, bool)
        self.ended[[rank for token, rank in ranks.items() if token.endswith(END_BYTE)]] = True
        self.kinds = np.array([{"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x3000)], np.uint8)

    def by_file(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            if self.piece is None or not (word.isascii() and word.isprintable() or PLAIN.match(word)):
                got = self.by_file(word)
            else:
                low = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
                if low.isalpha():
                    got = self._part(low)
                else:
                    got = b"".join([self.parts.get(p) or self._kept(p) for p in self.split.findall(low)])
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got

    def _kept(self, part: str) -> bytes:
        if len(self.parts) >= self.most:
            self.parts.clear()
        got = self.parts[part] = self._part(part)
        return got

    def _part(self, part: str) -> bytes:
        ids = self.piece(part.encode() + END_BYTE)
        return self.packers[len(ids)](*ids) if len(ids) < len(self.packers) else struct.pack(f"<{len(ids)}H", *ids)

    def of(self, text: str) -> bytes:
        if ODD.search(text):
            return self.by_file(text)
        return b"".join(map(self.__getitem__, text.split()))

    def of_all(self, texts: pa.Array, end: bytes) -> pa.Array:
        """The ids of each text with `end` behind; a word is looked up once, however often the texts have it."""
        odd = pc.match_substring_regex(texts, ODD.pattern)
        words = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        coded = words.flatten().dictionary_encode()
        ids = self._different(coded.dictionary).take(coded.indices)
        at = offsets(ids)[offsets(words) - words.offsets[0].as_py()].tolist()
        packed = ids.buffers()[2] or b""
        out = [bytes(packed[a:b]) + end for a, b in zip(at, at[1:])]
        for k in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[k] = self.by_file(texts[k].as_py()) + end
        return pa.array(out, pa.binary())

    def _different(self, words: pa.Array) -> pa.Array:
        """The ids of each word, words being different: most are lowered, cut and merged together, the others one by one."""
        quick = np.zeros(len(words), bool)
        if self.plain_split:
            plain = pc.match_substring_regex(words, r"\A" + PLAIN.pattern.replace(r"\Z", r"\z"))
            quick = pc.and_not(plain, pc.match_substring(words, "'")).to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(words.filter(pa.array(quick))).dictionary_encode()
        rest = [self[w] for w in words.filter(pa.array(~quick)).to_pylist()]
        both = pa.concat_arrays([self._cut(low.dictionary).take(low.indices), pa.array(rest, pa.large_binary())])
        place = np.empty(len(words), np.int64)
        place[np.concatenate([np.flatnonzero(quick), np.flatnonzero(~quick)])] = np.arange(len(words))
        return both.take(pa.array(place))

    def _cut(self, words: pa.Array) -> pa.Array:
        """The ids of plain words in small letters, cut where the split does: runs of letters, of other signs, single digits."""
        if not len(words):
            return pa.array([], pa.large_binary())
        bounds = offsets(words)
        raw = np.frombuffer(words.buffers()[2], np.uint8)[: bounds[-1]]
        kind = self.kinds[np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), "<u4")]
        at = np.flatnonzero(raw & 0xC0 != 0x80)
        first = np.zeros(len(raw), bool)
        first[bounds[:-1]] = True
        first = first[at]
        first[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        cuts = np.append(at[first], len(raw)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), words.buffers()[2]).dictionary_encode()
        ids = self._merged(parts.dictionary).take(parts.indices)
        return large_binary(offsets(ids)[np.searchsorted(cuts, bounds)], ids.buffers()[2])

    def _merged(self, parts: pa.Array) -> pa.Array:
        """The ids of each part; the tokens that end a part tell them from each other."""
        bounds = offsets(parts)
        raw = np.frombuffer(parts.buffers()[2], np.uint8)[: bounds[-1]]
        ids = np.array(self.ends_marked.encode_ordinary(str(np.insert(raw, bounds[1:], END_BYTE[0]), "utf-8")), "<u2")
        last = np.flatnonzero(self.ended[ids]) + 1
        if len(last) != len(parts):
            raise ValueError("a part must end with one token of a word's end")
        return large_binary(np.append(0, 2 * last), pa.py_buffer(ids))


def offsets(array: pa.Array) -> np.ndarray:
    """Where the values of a list, text or large binary array begin and end."""
    wide = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    if array.buffers()[1] is None:
        return np.zeros(1, wide)
    return np.frombuffer(array.buffers()[1], wide)[array.offset : array.offset + len(array) + 1]


def large_binary(bounds: np.ndarray, data: pa.Buffer) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), data])


def ids_of(path: str) -> Ids:
    """The file opened once in each Python process, with the words it has seen.

    Functions may travel to workers by value, each with globals of its own, so what is kept from
    task to task is kept in a module of the process.
    """
    held = sys.modules.setdefault("seriesforge_opened_files", types.ModuleType("seriesforge_opened_files")).__dict__
    if path not in held:
        held[path] = Ids(path)
    return held[path]
