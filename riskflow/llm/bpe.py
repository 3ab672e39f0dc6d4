"""Byte pair encoding and decoding with the vocabulary of a public tokenizer.

Encoding walks a word once. An Aho-Corasick automaton gives the longest token that starts at each
place; a token is kept if the merges would keep it next to the token before it, which a table of
compatible pairs answers, else the next shorter one is tried, else the walk steps back by a token.
Places that can't be completed are marked, so no place is tried twice with the same token. The tokens
are those that the merges give. Decoding copies pieces of one byte string by an offset table.

The vocabulary has word ends: the last character of a word and its end mark are one atom here.
"""

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import pairwise
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from riskflow.llm.common import chunks

#: Words that a task remembers the tokens of, twice at most, and the longest of them.
REMEMBERED_WORDS, REMEMBERED_LENGTH = 150_000, 64
#: The largest vocabulary file that is sent to the executors.
LARGEST_VOCABULARY = 64 << 20
#: Moves the character that ends a word away from the same character inside a word.
_END = 0xE000


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


# What the tokenizers library, whose tables are of Unicode 16, takes otherwise than Python and `regex` here do.
# Letters and numbers that came later, as first and last code point.
LATER_LETTERS = """
558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7cf-a7cf a7dd-a7dd a7e2-a7e2 a7f1-a7f1 ab6c-ab6d 107bb-107bf
10940-10959 10ec5-10ec7 10ed9-10eee 11b0a-11b0a 11db0-11ddb 11de0-11de9 11df1-11df1 1246f-1246f 12475-1247f 12550-12686
16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168-1b168
1d6a6-1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4
1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""
# Capitals that it lowers: first and last code point, first small letter.
LATER_CAPITALS = """
1c89-1c89:1c8a a7cb-a7cb:264 a7cc-a7cc:a7cd a7ce-a7ce:a7cf a7d2-a7d2:a7d3 a7d4-a7d4:a7d5 a7da-a7da:a7db a7dc-a7dc:19b
10d50-10d65:10d70 16ea0-16eb8:16ebb
"""


def _ranges(text: str) -> list[tuple[int, int]]:
    return [tuple(int(x, 16) for x in part.split(":")[0].split("-")) for part in text.split()]


def _small_letters() -> dict[int, int]:
    firsts = [int(part.split(":")[1], 16) for part in LATER_CAPITALS.split()]
    return {c: small + c - a for (a, b), small in zip(_ranges(LATER_CAPITALS), firsts, strict=True) for c in range(a, b + 1)}


def _without_later_letters(pattern: str) -> tuple[re.Pattern, regex.Pattern]:
    """A pattern for the later letters, and the given one, in which they are what is neither letter nor number."""
    ranges = "".join(f"{chr(a)}-{chr(b)}" for a, b in _ranges(LATER_LETTERS))
    # Either class is used in sets of its own or in the set of what is neither.
    without = pattern.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{ranges}])+")
    without = without.replace(r"[\p{L}]+", rf"[\p{{L}}--[{ranges}]]+").replace(r"|[\p{N}]|", rf"|[\p{{N}}--[{ranges}]]|")
    return re.compile(f"[{ranges}]"), regex.compile(without, regex.V1)


class OffsetTable:
    """Strings by number, as one byte string and the offsets at which they start."""

    def __init__(self, strings: list[bytes]):
        self.blob = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(s) for s in strings], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])[:-1]

    def concatenated(self, numbers: np.ndarray) -> bytes:
        if not len(numbers):
            return b""
        length = self.length[numbers]
        end = np.cumsum(length)
        shift = np.repeat(self.offset[numbers] - (end - length), length)
        return self.blob[shift + np.arange(end[-1])].tobytes()


class _Remembered(dict):
    """Words to the bytes of their token ids. Once it is full, words that aren't met again are forgotten."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.before.get(word)
        if found is None:
            found = array("i", self.encode(word)).tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found


class Tokenizer:
    """Encodes and decodes texts. `spec` is the text of the vocabulary file.

    Supported are files of the one kind this class is for: NFC, white space to a blank and lower case
    as normalisation, a split by a pattern whose matches stay, bytes as characters, and word ends.
    """

    def __init__(self, spec: str):
        parts = json.loads(spec)
        model, kinds = parts["model"], [n["type"] for n in parts["normalizer"]["normalizers"]]
        split = parts["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or not model["end_of_word_suffix"]:
            raise ValueError("this kind of vocabulary file is not supported")
        pattern = split["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.later_pattern, self.later_words = _without_later_letters(pattern)
        self.small_letters = _small_letters()
        self.first_later = chr(min(_ranges(LATER_LETTERS))[0])
        suffix, vocabulary = model["end_of_word_suffix"], model["vocab"]
        self.to_characters = {b: ord(c) for b, c in _byte_characters().items()}
        self.special = {x["content"]: x["id"] for x in parts["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

        def atoms(token: str) -> str:
            if not token.endswith(suffix) or token == suffix:
                return token
            body = token[: -len(suffix)]
            return body[:-1] + chr(_END + ord(body[-1]))

        # Tokens are numbered by the order of their merges, characters first.
        spelled = {atoms(t): i for t, i in vocabulary.items()}
        single = [t for t in spelled if len(t) == 1]
        number = {t: n for n, t in enumerate(single)}
        self.left, self.right = list(range(len(single))), list(range(len(single)))
        self.text = list(single)
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in model["merges"]:
            # The left part never ends a word.
            left, right = a, atoms(b)
            if left + right not in number:
                number[left + right] = len(self.text)
                self.text.append(left + right)
                self.left.append(number[left])
                self.right.append(number[right])
            self.merged[number[left], number[right]] = number[left + right]
        self.id = [spelled[t] for t in self.text]
        self.size = [len(t) for t in self.text]
        self.automaton = ahocorasick.Automaton()
        for n, t in enumerate(self.text):
            self.automaton.add_word(t, (len(t), n))
        self.automaton.make_automaton()
        # The longest token that is a proper prefix of each token, or -1.
        self.shorter = [next((number[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in number), -1) for t in self.text]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.remembered = _Remembered(self.encode_word)
        names = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        blank = "�"
        self.pieces = OffsetTable([(names.get(i, blank) + " ").encode() for i in range(max(names) + 1)])

    def _keeps(self, a: int, b: int) -> bool:
        """Whether the merges leave token `a` before token `b` as they are.

        Both are taken apart, the later merge first. If at some point the parts that touch have a
        merge of their own that comes before the merge that was last undone, that one would have won.
        """
        pair, limit, known = (a << 20) | b, len(self.text) + 1, True
        while True:
            if self.merged.get((a, b), limit) < limit:
                known = False
                break
            # Undo the later of both merges; of equal ones the right, as merges go from left to right.
            undo_left = a > b
            if undo_left and self.right[a] != a:
                limit, a = a, self.right[a]
            elif not undo_left and self.left[b] != b:
                limit, b = b + 1, self.left[b]
            elif self.right[a] != a:
                limit, a = a, self.right[a]
            elif self.left[b] != b:
                limit, b = b + 1, self.left[b]
            else:
                break
        if len(self.compatible) >= 2 * REMEMBERED_WORDS:
            self.compatible.clear()
        self.compatible[pair] = known
        return known

    def encode_word(self, word: str) -> list[int]:
        spelled = word.encode().decode("latin-1").translate(self.to_characters)
        spelled = spelled[:-1] + chr(_END + ord(spelled[-1]))
        count = len(spelled)
        longest = [-1] * count
        for end, (size, n) in self.automaton.iter(spelled):
            longest[end - size + 1] = n  # ends grow, so the last one is the longest
        if self.size[longest[0]] == count:
            return [self.id[longest[0]]]  # a whole word that is a token is left by the merges
        size, shorter, compatible = self.size, self.shorter, self.compatible
        open_at = bytearray(b"\1") * (count + 1)
        kept: list[int] = []
        place, token = 0, longest[0]
        while place < count:
            if token < 0:  # nothing fits here: step back over the token before
                open_at[place] = 0
                token = kept.pop()
                place -= size[token]
                token = shorter[token]
                continue
            end = place + size[token]
            if not open_at[end]:
                token = shorter[token]
                continue
            fits = compatible.get((kept[-1] << 20) | token) if kept else True
            if fits is None:
                fits = self._keeps(kept[-1], token)
            if fits:
                kept.append(token)
                place = end
                token = longest[place] if place < count else -1
            else:
                token = shorter[token]
        return [self.id[n] for n in kept]

    def _encode_plain(self, text: str) -> bytes:
        # Characters are lowered one by one, so a sigma that ends a word stays the common one.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        words = self.words
        if text and max(text) >= self.first_later:
            text = text.translate(self.small_letters)
            if self.later_pattern.search(text):
                words = self.later_words
        return b"".join(map(self.remembered.__getitem__, words.findall(text)))

    def encode(self, text: str) -> np.ndarray:
        if self.special_pattern is None or not any(s in text for s in self.special):
            return np.frombuffer(self._encode_plain(text), np.int32)
        parts = []
        for n, part in enumerate(self.special_pattern.split(text)):
            parts.append(np.int32(self.special[part]).tobytes() if n % 2 else self._encode_plain(part))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens as they are spelled in the file, with a blank between them."""
        return self.pieces.concatenated(ids)[:-1].decode()


_tokenizers: dict[str, Tokenizer] = {}


def _tokenizer(key: str, spec) -> Tokenizer:
    """One tokenizer for each vocabulary and Python process."""
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizer(spec.value)
    return _tokenizers[key]


def _send_vocabulary(spark: SparkSession, path: str):
    size = Path(path).stat().st_size
    if size > LARGEST_VOCABULARY:
        raise ValueError(f"{path} has {size} bytes; at most {LARGEST_VOCABULARY} are sent to the executors")
    return f"{path}:{size}", spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def _with_columns(docs: DataFrame, columns: list[StructField]) -> StructType:
    taken = {f.name for f in columns}
    return StructType([f for f in docs.schema.fields if f.name not in taken] + columns)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns of `docs`, with the token ids of the whole text in column `ids`.

    `decoded` names a column for what the ids decode to, if it is wanted. A null or empty text has no
    tokens and decodes to the empty string. Equal texts have equal ids; rows stay as they are, repeated
    ones too. Columns of `docs` with the new names are replaced. There is no shuffle.
    """
    key, spec = _send_vocabulary(docs.sparkSession, vocabulary)
    new = [StructField(ids, ArrayType(IntegerType(), False), False)]
    new += [StructField(decoded, StringType(), False)] if decoded else []
    schema = _with_columns(docs, new)
    kept = [f.name for f in schema.fields if f.name not in (ids, decoded)]
    source = f"__{text}__"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(key, spec)
        for batch in batches:
            for part in chunks(batch, source):
                found = [tokenizer.encode(t or "") for t in part.column(source).to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                arrays = [part.column(c) for c in kept]
                arrays.append(pa.ListArray.from_arrays(ends, np.concatenate([*found, np.zeros(0, np.int32)])))
                if decoded:
                    arrays.append(pa.array([tokenizer.decode(x) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *(f.name for f in new)])

    return docs.select(*kept, F.col(text).alias(source)).mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns of `rows`, with the text of the token ids in column `decoded`; null ids give "".

    An id that the vocabulary lacks fails. A column of that name is replaced.
    """
    key, spec = _send_vocabulary(rows.sparkSession, vocabulary)
    schema = _with_columns(rows, [StructField(decoded, StringType(), False)])
    kept = [f.name for f in schema.fields if f.name != decoded]
    source = "__ids__"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(key, spec)
        for batch in batches:
            column = batch.column(source)
            values = column.values.to_numpy(zero_copy_only=False).astype(np.int64)
            if len(values) and (values.min() < 0 or values.max() >= len(tokenizer.pieces.length)):
                raise ValueError("a token id is not in the vocabulary")
            texts = [tokenizer.decode(values[a:b]) for a, b in pairwise(column.offsets.to_pylist())]
            arrays = [batch.column(c) for c in kept] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, decoded])

    return rows.select(*kept, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias(source)).mapInArrow(run, schema)
