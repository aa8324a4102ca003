"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be joined by a
merge, so it marks a certain cut. Words are cut there, each fragment is merged on its own (and kept
in a bounded cache, since fragments recur) and the ids are put together again. The result is what
merging the whole text would give.

Edge cases: a null or empty text has no ids and decodes to the empty text; literal special tokens in
a text get the special ids, as the tokenizers library does by default; white space gives no ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from recordwatch.llm.common import text_or_empty

#: Words that one worker keeps in its cache, in each of two generations.
CACHE_ENTRIES = 500_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(rest)) for b in range(256)]


class _Cache(dict):
    """Text -> ids as packed 32-bit integers. When full it becomes the old generation, whose entries return on use."""

    def __init__(self, compute: Callable[[str], bytes], size: int) -> None:
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        if found is None:
            found = self.compute(text)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[text] = found
        return found


class Bpe:
    """Encoder and decoder for one tokenizer file of the word-end BPE kind."""

    def __init__(self, spec: str, cache_entries: int = CACHE_ENTRIES) -> None:
        parsed = json.loads(spec)
        model = parsed["model"]
        self.spec, self.library = spec, None
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[str, str], int] = {}
        for k, pair in enumerate(model["merges"]):
            self.rank[tuple(pair if isinstance(pair, list) else pair.split(" "))] = k
        self.special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        self.joinable = {pair for token in self.vocab for pair in self._pairs(token)}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.names = [self.token.get(i, "") for i in range(max(self.token, default=-1) + 1)]
        self.words = _Cache(self.encode_word, cache_entries)
        # Letters from U+0250 on, and those below whose lower cases lie beyond.
        beyond = "".join(c for c in map(chr, range(0x250)) if max(c.lower()) > "\u024f")
        self.far = re.compile(f"[{beyond}\u0250-\U0010ffff]")
        # After lower-casing; letters, digits and marks up to U+024F, where all versions of Unicode agree.
        self.near = re.compile(
            "'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
            "|[^\\t-\\r \x85\xa0a-zA-Z0-9\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ\xb2\xb3\xb9\xbc-\xbe]+"
        )

    def _pairs(self, token: str) -> Iterator[str]:
        body = token.removesuffix(self.suffix) if self.suffix and token != self.suffix else token
        return (body[i : i + 2] for i in range(len(body) - 1))

    def fragments(self, word: str) -> list[str]:
        """``word`` (as byte letters) cut wherever two neighbours occur together in no token."""
        out, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.joinable:
                out.append(word[start:i])
                start = i
        return [*out, word[start:]]

    def merge(self, fragment: str, at_end: bool) -> list[str]:
        """The tokens of one fragment: always the best-ranked pair first, the leftmost of equals."""
        parts, rank, far = list(fragment), self.rank.get, len(self.rank)
        if at_end:
            parts[-1] += self.suffix
        ranks = [rank(pair, far) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == far:
                break
            i = ranks.index(best)
            parts[i] = joined = parts[i] + parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], joined), far)
            if i < len(ranks):
                ranks[i] = rank((joined, parts[i + 1]), far)
        return parts

    def encode_word(self, word: str) -> bytes:
        letters = self.letters
        shown = word if word.isascii() and word.isalpha() else "".join(letters[b] for b in word.encode())
        cuts = self.fragments(shown)
        ids = [self.vocab[t] for k, f in enumerate(cuts) for t in self.merge(f, k == len(cuts) - 1)]
        return array("I", ids).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """Any piece of text between white space, or between two special tokens."""
        parts = self.special_split.split(chunk) if self.special_split else [chunk]
        return b"".join(array("I", [self.special[p]]).tobytes() if p in self.special else self.encode_plain(p) for p in parts if p)

    def encode_plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.near.findall(text.lower()) if text.isascii() else self.by_library(text)))

    def by_library(self, text: str) -> list[str]:
        """Words of rarer scripts, cut by the library's own tables."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec)
        back = {c: b for b, c in enumerate(self.letters)}
        shown = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(back[c] for c in word).decode("utf-8", "surrogateescape") for word, _ in shown]

    def encode(self, text: str | None) -> bytes:
        """All ids of ``text`` as packed 32-bit integers."""
        if not text:
            return b""
        if "<|" not in text and (text.isascii() or not self.far.search(text)):
            plain = text if text.isascii() else unicodedata.normalize("NFC", text)
            return b"".join(map(self.words.__getitem__, self.near.findall(plain.lower())))
        # White space parts words, so chunks between it can be taken one by one.
        return b"".join(map(self.encode_chunk, filter(None, re.split("[\\t-\\r \x85\xa0]+", text))))

    def decode(self, ids: array) -> str:
        """The tokens of ``ids`` joined by blanks, special tokens included (the file names no decoder)."""
        return " ".join(map(self.names.__getitem__, ids))


_LOADED: dict[str, Bpe] = {}


def load(spec: str) -> Bpe:
    """One encoder per worker process and tokenizer file, so that caches outlive a task."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(spec)
    return _LOADED[key]


def read_spec(path: str) -> str:
    """A tokenizer file, read by the driver; executors get its text in a broadcast of a few MB."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text with the tokenizer file ``tokenizer``.

    One row per input row: the id, ``ids`` (array of int) and ``decoded``. No row depends on another,
    so there is no shuffle. Null texts are empty; other columns are ignored.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        for batch in batches:
            ids = [array("I", bpe.encode(t)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.string())], ["key", "ids", "decoded"])

    source = docs.select(docs[id_col].alias("key"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(run, f"key {docs.schema[id_col].dataType.simpleString()}, ids array<int>, decoded string").withColumnRenamed("key", id_col)


def encode_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document, digested where it is encoded.

    The same as hashing the columns of :func:`encode_documents`, without sending ids back to the JVM.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        numbers = list(map(str, range(len(bpe.names))))
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids = array("I", bpe.encode(text))
                n.append(len(ids))
                of_ids.append(sha(" ".join(map(numbers.__getitem__, ids))))
                of_text.append(sha(bpe.decode(ids)))
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
