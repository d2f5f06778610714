"""BPE encoding and decoding by a depth-first walk over the trie of distinct words.

A prefix of a word has one byte-pair encoding, and all of it but its last token is the encoding of a
shorter prefix. So each trie node keeps only the last token of its prefix: the one token that ends the
prefix and can follow the last token of the prefix before it. Sorted distinct words are the trie's
depth-first order; the walk keeps the states of the current path and computes those of a shared
prefix once. Two tokens can follow each other if no merge crosses their border while it is open.

encode_column(): ids as the `tokenizers` library gives them with add_special_tokens=False
(special tokens in the text are recognised); decode_column() as its decode(ids,
skip_special_tokens=False). The tokenizer's JSON goes to the executors as a broadcast of its few MB.

Defined cases: a null text is an empty text; an empty text has no tokens and decodes to an empty text;
long words take time in proportion to their length; rows are independent, so ties, repeated rows and
other columns don't matter; ids that don't form UTF-8 decode with replacement characters.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, map_arrow, release, slices

#: How byte-level tokenizers split text before merging; white space is Unicode's.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: The same for an engine that needs no class of its own for white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, and pairs of tokens, kept from one batch to the next by a Python worker, and the longest of the words.
KEPT_WORDS, KEPT_LENGTH = 150_000, 48


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes with the byte-level BPE of a tokenizer's JSON."""

    def __init__(self, config: str) -> None:
        j = json.loads(config)
        model = j["model"]
        if model["type"] != "BPE" or j["normalizer"] or j["pre_tokenizer"]["type"] != "ByteLevel" or j["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without normalizer and prefix space")
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.bytes = {i: to_bytes(s) for s, i in model["vocab"].items()}
        self.ids = {b: i for i, b in self.bytes.items()}
        self.special = {x["content"]: x["id"] for x in j["added_tokens"]}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("|".join(f"({regex.escape(s)})" for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        vocab = model["vocab"]
        for n, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = vocab[a], vocab[b]
            if (left, right) not in self.rank:
                self.rank[left, right] = n
                self.made.setdefault(vocab[a + b], (left, right, n))
        #: Every ending of a token: the token that it is, or -1.
        self.ending = {b[i:]: -1 for b in self.ids for i in range(len(b))}
        self.follows: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.ending |= {b: i for b, i in self.ids.items() if self._merges_to(i)}
        self.words: dict[str, str] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of a token while it is merged, first to last, each with the rank of the merge that ends it."""
        if (found := self.spines.get((token, side))) is None:
            found, t, end = [], token, float("inf")
            while True:
                found.append((t, end))
                if t not in self.made:
                    break
                left, right, end = self.made[t]
                t = right if side else left
            found.reverse()
            self.spines[token, side] = found
        return found

    def can_follow(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both never crosses their border."""
        if (known := self.follows.get((first, second))) is not None:
            return known
        a, b, i, j, ok = self.spine(first, 1), self.spine(second, 0), 0, 0, True
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            n = self.rank.get((x, y))
            if n is not None and n < x_end and n <= y_end:  # of equal merges the left one goes first
                ok = False
                break
            if x_end <= y_end and i + 1 < len(a):
                i += 1
            elif j + 1 < len(b):
                j += 1
            else:
                break
        self.follows[first, second] = ok
        return ok

    def _merges_to(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        parts = [self.ids[bytes((b,))] for b in self.bytes[token]]
        while len(parts) > 1:
            n, k = min((self.rank.get(p, float("inf")), k) for k, p in enumerate(zip(parts, parts[1:], strict=False)))
            if n == float("inf"):
                return False
            parts[k : k + 2] = [self.ids[self.bytes[parts[k]] + self.bytes[parts[k + 1]]]]
        return parts == [token]

    def walk(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of sorted words, by the last tokens along the current path of their trie."""
        ending, follows, can_follow = self.ending, self.follows, self.can_follow
        last: list[int] = [-1]
        size: list[int] = [0]
        before = b""
        for word in words:
            shared, n = 0, min(len(word), len(before))
            while shared < n and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                start = end
                while start:
                    start -= 1
                    token = ending[word[start:end]]  # a missing one: no token ends so
                    if token < 0:
                        continue
                    if start:
                        ok = follows.get((last[start], token))
                        if not (can_follow(last[start], token) if ok is None else ok):
                            continue
                    break
                else:
                    raise KeyError(word)
                last.append(token)
                size.append(end - start)
            out, at = [], len(word)
            while at:
                out.append(last[at])
                at -= size[at]
            yield out[::-1]
            before = word

    def split(self, text: str) -> list[str]:
        """Words and special tokens, in order."""
        if self.cut is None or not any(s in text for s in self.special):
            return SPLIT.findall(text)
        out: list[str] = []
        for part in self.cut.splititer(text):
            if part is not None:
                out += [part] if part in self.special else SPLIT.findall(part)
        return out

    def encode_batch(self, texts: list[str]) -> list[list[str]]:
        """For each text its words' ids, each as decimals joined by commas."""
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        if len(self.follows) > KEPT_WORDS:
            self.follows.clear()
            self.spines.clear()
        known = self.words
        known.update((s, str(i)) for s, i in self.special.items())
        parts = [self.split(t) for t in texts]
        new = sorted((w.encode(), w) for w in set(chain.from_iterable(parts)).difference(known))
        for (_, word), ids in zip(new, self.walk(b for b, _ in new), strict=True):
            known[word] = ",".join(map(str, ids))
        get = known.__getitem__
        out = [list(map(get, p)) for p in parts]
        for _, word in new:
            if len(word) > KEPT_LENGTH:
                del known[word]
        return out

    def decode_parts(self, parts: list[str]) -> bytes:
        """The bytes of ids, given as decimals joined by commas, in parts."""
        known = {p: b"".join(map(self.bytes.__getitem__, map(int, p.split(",")))) for p in set(parts)}
        return b"".join(map(known.__getitem__, parts))


_codecs: dict[str, Codec] = {}


def codec(config: str) -> Codec:
    key = hashlib.sha256(config.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(config)
    return _codecs[key]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_encoders: dict[str, Callable[[str], bytes]] = {}


def fast_encoder(config: str) -> Callable[[str], bytes]:
    """A function that gives a text's ids as little-endian unsigned 32-bit numbers, without the trie: for work that only needs ids.

    Where the vocabulary's numbers are in the order of its merges this is tiktoken with the same tokens, else (and for texts that it can't take) the codec.
    """
    key = hashlib.sha256(config.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = _encoder(config)
    return _encoders[key]


def drop_encoders() -> None:
    _encoders.clear()
    _codecs.clear()


def _encoder(config: str) -> Callable[[str], bytes]:
    import tiktoken

    def slow(text: str) -> bytes:
        return b"".join(int(i).to_bytes(4, "little") for p in codec(config).encode_batch([text]) for x in p for i in x.split(","))

    j = json.loads(config)
    vocab, letters = j["model"]["vocab"], byte_letters()
    special = {x["content"]: x["id"] for x in j["added_tokens"]}
    made = [vocab["".join(p) if isinstance(p, list) else p.replace(" ", "")] for p in j["model"]["merges"]]
    ranks = {bytes(letters[c] for c in s): i for s, i in vocab.items() if s not in special}
    if any(x >= y for x, y in zip(made, made[1:], strict=False)) or len(made) + 256 != len(ranks):
        return slow
    quick = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    allowed = set(special)

    def encode(text: str) -> bytes:
        try:
            return quick.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()).astype("<u4").tobytes()
        except BaseException as e:
            if isinstance(e, KeyboardInterrupt | SystemExit | MemoryError):
                raise
            return slow(text)  # a run of white space or letters too long for its regular expressions

    return encode


def shipped_tokenizer(df: DataFrame, path: str | None):
    """The tokenizer's JSON as a broadcast of its few MB."""
    with open(path or default_tokenizer(), encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_column(df: DataFrame, column: str = "text", into: str = "token_ids", tokenizer: str | None = None) -> DataFrame:
    """df with an array of ids; `into` replaces a column of that name."""
    shipped = shipped_tokenizer(df, tokenizer)

    @F.pandas_udf("array<int>")
    def encode(texts):
        import numpy as np
        import pandas as pd

        c = codec(shipped.value)
        return pd.Series([np.array(",".join(p).split(",") if p else [], dtype=np.int32) for p in c.encode_batch(texts.fillna("").tolist())])

    return df.withColumn(into, encode(F.col(f"`{column}`")))


def decode_column(df: DataFrame, column: str = "token_ids", into: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """df with the text of an array of ids; null ids decode to an empty text."""
    shipped = shipped_tokenizer(df, tokenizer)

    @F.pandas_udf("string")
    def decode(rows):
        import pandas as pd

        c = codec(shipped.value)
        return pd.Series(["" if r is None else b"".join(c.bytes[int(i)] for i in r).decode("utf-8", "replace") for r in rows])

    return df.withColumn(into, decode(F.col(f"`{column}`")))


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    shipped = shipped_tokenizer(docs, tokenizer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bpe", _codecs.clear)
        c, sha = codec(shipped.value), lambda b: hashlib.sha256(b).hexdigest()
        for batch in slices(batches, most=2 << 20):
            n, ids, back = [], [], []
            for parts in c.encode_batch([t or "" for t in batch.column(1).to_pylist()]):
                joined = ",".join(parts)
                n.append(joined.count(",") + 1 if parts else 0)
                ids.append(sha(joined.encode()))
                back.append(sha(c.decode_parts(parts).decode("utf-8", "replace").encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        release()

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
