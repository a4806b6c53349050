"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The vocabulary's tokens become an Aho-Corasick automaton. Tokens are taken from the left, the longest that
starts at the place first; one that byte-pair merging would not leave beside the token before it is given
up for the next shorter one, and where none is left the token before goes back a step. A place given up
is not tried again, so the work is linear. Whether two tokens can stand side by side is a table, filled
as pairs come up: going back through the merges that made both, no merge across their border may come
before the merges on either side. What remains is the one sequence that merging gives, exactly.

Before merging, texts go through the steps that the vocabulary's file names (normal form, white space, case,
split pattern, bytes). None of these looks across white space, so texts are taken apart there and every piece
is worked out once and looked up after. Decoding is one gather from the bytes of all tokens by a table of
offsets.

Defined cases: NULL text is empty text and has no tokens; special tokens written in a text are those
tokens, as in the library; a NULL list of ids stays NULL, a NULL id in one is left out, and an id outside the
vocabulary is left out, too; an empty table gives no rows; repeated rows and rows without an id are encoded
each; other columns stay, and a column that has the name of a result is replaced. Texts of any length are
encoded whole; pieces over ``LONG_PIECE`` characters are not remembered.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Pieces, words and token pairs that a task remembers, and the characters of the longest it remembers.
PIECES, PAIRS, LONG_PIECE = 250_000, 500_000, 64
#: Finds a character beyond U+00FF; all others are letters, marks and signs that every table knows alike.
BEYOND_LATIN = re.compile("[^\x00-\xff]").search
#: Rows that leave a task together hold about so many bytes or tokens; tokens gathered at a time.
CHUNK, GATHER = 2_000_000, 200_000
#: White space as the split pattern and the normal form see it.
SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Characters at which ``str.split`` cuts although they are no white space here.
NO_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the steps before them, from a file of the public ``tokenizers`` format."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.lowers = "Lowercase" in self._steps(content.get("normalizer"))
        self.library = Tokenizer.from_file(path)
        self.pattern = regex.compile(self._split(content["pre_tokenizer"]))
        self.plain = self.pattern.findall("abcdefgh") == ["abcdefgh"]  # letters stay together
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("unk_token") or content.get("decoder"):
            raise ValueError("a byte-pair vocabulary without unknown token, fallback and decoder is expected")

        ids: dict[str, int] = model["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        size = 1 + max([*ids.values(), *self.special.values()])
        #: per token: its merge's place in order (-1: a base symbol) and the two tokens it was made of
        self.order, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(pairs):
            token, one, two = ids[a + b], ids[a], ids[b]
            if self.order[token] >= 0 or max(self.order[one], self.order[two]) >= rank:
                raise ValueError(f"the merge of {a!r} and {b!r} does not come once, after those that make its parts")
            self.order[token], self.left[token], self.right[token] = rank, one, two
            self.merge[one, two] = token
        self.size, self.beside = size, dict[int, bool]()
        letters = [name for name in ids if len(name.removesuffix(self.end) if self.end else name) == 1]
        self.letters = {c: k for k, c in enumerate(byte_letters())}
        # a letter at a word's end is a symbol of its own, written 256 places on
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        whole: dict[str, int] = {}
        for name, token in ids.items():
            if self.order[token] >= 0 and not self._compatible(self.left[token], self.right[token], self.order[token]):
                continue  # merging its letters ends elsewhere, so it never stands in a result
            if self.order[token] < 0 and name not in letters:
                continue
            whole[self._symbols(name)] = token
        for symbols, token in whole.items():
            self.automaton.add_word(symbols, token)
        self.automaton.make_automaton()
        self.length = [0] * size
        for symbols, token in whole.items():
            self.length[token] = len(symbols)
        #: per token: the longest shorter token that begins it
        self.shorter = [-1] * size
        for symbols, token in whole.items():
            for n in range(len(symbols) - 1, 0, -1):
                if symbols[:n] in whole:
                    self.shorter[token] = whole[symbols[:n]]
                    break
        self.seen: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    @staticmethod
    def _steps(step: dict | None) -> list[str]:
        found = [] if step is None else step["normalizers"] if step["type"] == "Sequence" else [step]
        kinds = [s["type"] for s in found]
        spaced = [s for s in found if s["type"] == "Replace" and (s["pattern"], s["content"]) == ({"Regex": "\\s+"}, " ")]
        if not set(kinds) <= {"NFC", "Lowercase", "Replace"} or len(spaced) != kinds.count("Replace"):
            raise ValueError(f"steps {kinds} are not known")
        return kinds

    @staticmethod
    def _split(step: dict) -> str:
        """The pattern of the words; what is between them is dropped, white space among it."""
        if step["type"] == "Sequence" and [s["type"] for s in step["pretokenizers"]] == ["Split", "ByteLevel"]:
            split, byte_level = step["pretokenizers"]
            if split["behavior"] == "Removed" and split["invert"] and not byte_level["add_prefix_space"] and not byte_level["use_regex"]:
                return split["pattern"]["Regex"]
        raise ValueError("a split by a pattern of words, then bytes, is expected")

    def _symbols(self, name: str) -> str:
        last = bool(self.end) and name.endswith(self.end) and len(name) > len(self.end)
        codes = [self.letters[c] for c in (name[: -len(self.end)] if last else name)]
        return "".join(map(chr, codes[:-1])) + chr(codes[-1] + 256 * last)

    def _compatible(self, a: int, b: int, before: int) -> bool:
        """No merge that comes before ``before`` joins the end of ``a`` to the start of ``b``, if the
        merges on both sides happen in their order."""
        order, merge = self.order, self.merge
        bar = before
        while True:
            joined = merge.get((a, b))
            if joined is not None and order[joined] < bar:
                return False
            # undo the later merge of the two; of equal ones the left was made first
            if order[a] < 0 and order[b] < 0:
                return True
            if order[a] > order[b]:
                bar, a = min(bar, order[a]), self.right[a]
            else:
                bar, b = min(bar, order[b] + 1), self.left[b]

    def fits(self, a: int, b: int) -> bool:
        """Works out an entry of the table of pairs."""
        if len(self.beside) >= PAIRS:
            self.beside.clear()
        found = self.beside[a * self.size + b] = self._compatible(a, b, 1 << 60)
        return found

    def encode_word(self, raw: bytes) -> list[int]:
        """The tokens of one word, in UTF-8."""
        symbols = raw.decode("latin-1")
        if self.end:
            symbols = symbols[:-1] + chr(raw[-1] + 256)
        length, shorter, beside, size = self.length, self.shorter, self.beside, self.size
        n = len(symbols)
        longest = [-1] * (n + 1)
        for last, token in self.automaton.iter(symbols):
            longest[last + 1 - length[token]] = token  # a later end is a longer token
        taken: list[int] = []
        open_ = [True] * (n + 1)
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                to = at + length[token]
                if open_[to]:
                    fits = before < 0 or beside.get(before * size + token)
                    if fits is None:
                        fits = self.fits(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                at, before, token = to, token, longest[to]
            else:
                if not taken:
                    raise ValueError(f"no tokens for {raw!r}")
                open_[at] = False
                at -= length[before]
                token = shorter[taken.pop()]
                before = taken[-1] if taken else -1
        return taken

    def word(self, word: str, raw: bytes) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = array("i", self.encode_word(raw)).tobytes()
            remember(self.words, word, found)
        return found

    def encode_piece(self, piece: str) -> bytes:
        """The tokens of text without white space, as 32-bit numbers."""
        if not BEYOND_LATIN(piece):  # no change by the normal form but case
            piece = piece.lower() if self.lowers else piece
            found = [piece] if piece.isalpha() and self.plain else self.pattern.findall(piece)
            return b"".join([self.word(word, word.encode()) for word in found])
        # the library's own steps, whose tables know other characters than Python's
        piece = self.library.normalizer.normalize_str(piece) if self.library.normalizer else piece
        found = [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(piece)]
        return b"".join([self.word("\n" + word, bytes(map(self.letters.__getitem__, word))) for word in found])

    def encode(self, text: str) -> bytes:
        """The tokens of a text, as 32-bit numbers."""
        out: list[bytes] = []
        seen = self.seen
        parts = self.cut.split(text) if self.cut and "<" in text else (text,)
        for part in parts:
            if part in self.special:
                out.append(np.int32(self.special[part]).tobytes())
                continue
            if self.lowers and not BEYOND_LATIN(part):
                part = part.lower()
            for piece in pieces(part):
                found = seen.get(piece)
                if found is None:
                    found = self.encode_piece(piece)
                    remember(seen, piece, found)
                out.append(found)
        return b"".join(out)


class Offsets:
    """All tokens' text in one string of bytes and where each begins."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"] | {t["content"]: t["id"] for t in content["added_tokens"]}
        if content.get("decoder"):
            raise ValueError("a vocabulary without a decoder is expected")
        names = [b""] * (1 + max(ids.values()))
        for name, token in ids.items():
            names[token] = name.encode()
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in names])]).astype(np.int64)
        self.body = np.frombuffer(b"".join(names), dtype=np.uint8)

    def gather(self, ids: np.ndarray) -> bytes:
        """The tokens' text, a space behind each."""
        size = self.offsets[ids + 1] - self.offsets[ids] + 1
        to = np.cumsum(size)
        out = np.full(int(size.sum()), 0x20, dtype=np.uint8)
        place = np.arange(len(out)) - np.repeat(to - size, size)
        inside = place < np.repeat(size - 1, size)
        out[inside] = self.body[(np.repeat(self.offsets[ids], size) + place)[inside]]
        return out.tobytes()

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The tokens of every list, joined by a space; ``starts`` are the lists' bounds in ``ids``."""
        body = b"".join(self.gather(ids[k : k + GATHER]) for k in range(0, len(ids), GATHER))
        bounds = np.concatenate([[0], np.cumsum(self.offsets[ids + 1] - self.offsets[ids] + 1)])[starts]
        return [body[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def remember(cache: dict[str, bytes], text: str, found: bytes) -> None:
    if len(text) <= LONG_PIECE:
        if len(cache) >= PIECES:
            cache.clear()
        cache[text] = found


def pieces(text: str) -> list[str]:
    if any(c in text for c in NO_SPACE):
        for c in SPACE[1:]:
            text = text.replace(c, "\t")
        return [p for p in text.split("\t") if p]
    return text.split()


def with_column(docs: DataFrame, name: str, kind) -> StructType:
    """The schema of ``docs`` with ``name`` last."""
    return StructType([f for f in docs.schema.fields if f.name != name] + [StructField(name, kind)])


def chunks(batch: pa.RecordBatch, sizes: list[int], limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` by the rows' sizes."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield batch.slice(start, k + 1 - start)
            start, total = k + 1, 0
    if start < len(sizes):
        yield batch.slice(start)


def replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], [*names, name])


def encode_documents(docs: DataFrame, vocabulary_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(vocabulary_path)
        for whole in batches:
            for batch in chunks(whole, [len(t.as_buffer()) if t.is_valid else 0 for t in whole.column(text)], CHUNK):
                found = [vocabulary.encode(t or "") for t in batch.column(text).to_pylist()]
                starts = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
                yield replaced(batch, out, pa.ListArray.from_arrays(pa.array(starts), values))

    return docs.mapInArrow(run, with_column(docs, out, ArrayType(IntegerType())))


def decode_documents(docs: DataFrame, vocabulary_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of their token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Offsets(vocabulary_path)
        known = len(tokens.offsets) - 1
        for whole in batches:
            for batch in chunks(whole, [len(x) if x.is_valid else 0 for x in whole.column(ids)], CHUNK):
                column = batch.column(ids)
                size = np.array([len(x) if x.is_valid else 0 for x in column])
                flat = column.flatten()
                values = flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                usable = (values >= 0) & (values < known)
                starts = np.concatenate([[0], np.cumsum(size)])
                starts = np.concatenate([[0], np.cumsum(usable)])[starts]
                texts = tokens.decode(values[usable], starts)
                yield replaced(batch, out, pa.array([t if x.is_valid else None for t, x in zip(texts, column)], pa.string()))

    return docs.mapInArrow(run, with_column(docs, out, StringType()))
