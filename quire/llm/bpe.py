"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut into chunks where a rolling hash of the last 16 bytes meets a mask, so copied passages give the same
chunks wherever they stand. A chunk is encoded once and reused by all documents that its worker meets. Its tokens are
final only between its first and its last *safe cut*: a position before a single space that stands between two
characters that are no white space. What lies between the last safe cut of one chunk and the first of the next is the
join: it is encoded again as one text (a chunk without a safe cut is taken into it), and then once more in a window that
is wider by a piece of either chunk. The join is good if the wider window's tokens are exactly the one chunk's last
tokens, the join's and the other's first; a text with a join that doesn't agree is encoded as a whole by the library.

Decoding takes a document's ids, one after another, as the library does.

Defined results: a null text counts as empty; an empty text has no tokens; repeated rows give repeated results; extra
columns are kept out of the digests; a text of any length is held once, with its tokens. Caches are bounded (two
generations of `chunk_bytes` each), live as long as their worker, and only save work: results don't depend on them.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.common import give_back, mix, power_table, slices, small_batches, utf8

#: A chunk ends where the rolling hash of ROLL bytes has MASK bits zero: 512 bytes on average.
ROLL, MASK = 16, 511
#: A single space between characters that are no white space; before it, a pre-token ends.
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Beyond Latin letters and common white space, libraries may differ in their Unicode tables.
OTHER = re.compile("[^\\x00-\\u024f]|[\\x1c-\\x1f\\x85\\xa0]")
#: Fixed value: the pre-tokenizing pattern of byte-level vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROLL_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def byte_values() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes, by the public rule."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ChunkCodec:
    """Encodes as tokenizers' Tokenizer does with add_special_tokens=False, and decodes as it does with skip_special_tokens=False."""

    def __init__(self, path: str, chunk_bytes: int = 24 << 20):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        values = byte_values()
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = token.encode() if token in special else bytes(values[c] for c in token)
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.special = sorted(special)
        stated = json.loads(Path(path).read_text(encoding="utf-8"))
        before = stated.get("pre_tokenizer") or {}
        # safe cuts are safe where nothing but the byte-level pattern looks at a text before the merges
        self.cuttable = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not stated.get("normalizer") and not any(x.isspace() for t in special for x in t)
        self.fast = self._ranked(vocab, special) if self.cuttable else None
        self.new, self.old, self.size, self.chunk_bytes = {}, {}, 0, chunk_bytes

    def _ranked(self, vocab: dict[str, int], special: set[str]):
        """A rank-driven encoder of the same vocabulary, for pieces of Latin letters; None if it can't be proved equal.

        It merges any neighbours whose bytes are a token, the library only listed pairs. If each token, encoded alone by
        the library, is itself, then the state within a token's span is always the listed pair when its rank is due, so
        both give the same tokens. That is checked here for the whole vocabulary.
        """
        try:
            import tiktoken
        except ImportError:
            return None
        own = {t: i for t, i in vocab.items() if t not in special}
        model = self.tokenizer.model
        try:
            if sorted(own.values()) != [*range(len(own))] or any([k.id for k in model.tokenize(t)] != [i] for t, i in own.items()):
                return None
        except Exception:  # noqa: BLE001  a model that can't be asked token by token
            return None
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks={self.bytes_of[i]: i for i in own.values()}, special_tokens={})

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def beyond(self, text: str) -> bool:
        """Whether a text is for the library alone."""
        return OTHER.search(text) is not None or any(x in text for x in self.special)

    def ids_of(self, text: str) -> list[int]:
        """Tokens of a text that begins and ends at safe cuts or at a document's ends."""
        if not text:
            return []
        if self.fast is None:
            return self.library(text)
        if not self.beyond(text):
            return self.fast.encode_ordinary(text)
        out, begin, odd = [], 0, None
        edges = [0, *(m.start() for m in SAFE.finditer(text) if m.start()), len(text)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if (now := self.beyond(text[a:b])) != odd:
                if a:
                    out += self.library(text[begin:a]) if odd else self.fast.encode_ordinary(text[begin:a])
                begin, odd = a, now
        return out + (self.library(text[begin:]) if odd else self.fast.encode_ordinary(text[begin:]))

    def chunk(self, text: str) -> tuple:
        """Head before the first safe cut, tokens from there to the last, tail; the first and the last piece between safe
        cuts, each with its tokens. Without a safe cut all is head, and there are no tokens."""
        if (found := self.new.get(text)) is not None:
            return found
        if (found := self.old.get(text)) is None:
            cuts = [m.start() for m in SAFE.finditer(text)]
            if not cuts:
                found = (text, None, "", "", [], "", [])
            else:
                a, b = cuts[0], cuts[-1]
                core = self.ids_of(text[a:b])
                opening, closing = (text[a : cuts[1]], text[cuts[-2] : b]) if len(cuts) > 1 else ("", "")
                found = (text[:a], core, text[b:], opening, self.begins(core, opening), closing, self.begins(core[::-1], closing)[::-1])
        size = 12 * len(text) + 800
        if self.size + size > self.chunk_bytes:
            self.old, self.new, self.size = self.new, {}, 0
        self.new[text] = found
        self.size += size
        return found

    def begins(self, ids: list[int], text: str) -> list[int]:
        """The first ids, as many as hold the text's bytes or more."""
        n, left = 0, len(text.encode())
        while left > 0 and n < len(ids):
            left -= len(self.bytes_of[ids[n]])
            n += 1
        return ids[:n]

    def encode(self, text: str, cuts: list[int] | None = None) -> list[int]:
        """A text's tokens. cuts: the chunks' ends as byte offsets into the text's UTF-8."""
        if not self.cuttable:
            return self.library(text)
        raw = text.encode("utf-8")
        if cuts is None:
            cuts = chunk_ends(np.frombuffer(raw, np.uint8))[1]
        ids, at, join, before, last = [], 0, "", "", []
        for end in [*cuts, len(raw)]:
            if end <= at:
                continue
            head, core, tail, opening, first, closing, ending = self.chunk(raw[at:end].decode("utf-8"))
            at = end
            join += head
            if core is None:
                continue  # no safe cut: the join goes on into the next chunk
            own = self.ids_of(join)
            if self.ids_of(before + join + opening) != last + own + first:
                return self.library(text)
            ids += own
            ids += core
            join, before, last = tail, closing, ending
        own = self.ids_of(join)
        if before and self.ids_of(before + join) != last + own:
            return self.library(text)
        return ids + own

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def chunk_ends(data: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Positions where chunks end by content: after ROLL bytes whose hash meets the mask, moved on to the next character."""
    if len(data) <= ROLL:
        return np.zeros(0, np.int64), []
    up, down = power_table(ROLL_BASE, len(data)), power_table(np.uint64(pow(int(ROLL_BASE), -1, 1 << 64)), len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    n = len(data) - ROLL + 1
    rolled = mix((sums[ROLL:] - sums[:n]) * down[:n])
    at = np.flatnonzero((rolled & np.uint64(MASK)) == 0) + ROLL
    for _ in range(3):  # a character has three continuation bytes at most
        inside = at < len(data)
        at[inside] += (data[at[inside]] & 0xC0) == 0x80
    at = np.unique(at[at < len(data)])
    return at, at.tolist()


_codec: dict[str, ChunkCodec] = {}


def codec(path: str) -> ChunkCodec:
    """One for each Python worker; workers are reused, and so are the vocabulary and the chunks."""
    if path not in _codec:
        _codec[path] = ChunkCodec(path)
    return _codec[path]


def listed(lists: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *lists])))


def encode_documents(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Columns `keep`, then n_tokens, ids_sha256, decoded_sha256, and token_ids (array<int>) if asked for.

    `tokenizer_path` is read on the executors, where the vocabulary files are installed.
    """
    small_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "n_tokens long, ids_sha256 string, decoded_sha256 string", *["token_ids array<int>"] * with_ids])
    names = [*keep]

    def run(batches):
        own = codec(tokenizer_path)
        for batch in batches:
            data, off = utf8(batch, len(names))
            n, digests, decoded, lists = [], [], [], []
            for a, b in slices(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                ends = chunk_ends(part)[0]
                raw, lo = part.tobytes(), np.searchsorted(ends, at)
                for i in range(b - a):
                    s = int(at[i])
                    ids = own.encode(raw[s : int(at[i + 1])].decode("utf-8"), (ends[lo[i] : lo[i + 1]] - s).tolist())
                    n.append(len(ids))
                    digests.append(hashlib.sha256(",".join(map(own.decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
                    if with_ids:
                        lists.append(np.array(ids, np.int32))
            made = [pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string()), *[listed(lists)] * with_ids]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], [*names, "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * with_ids])
        give_back()

    return docs.select(*[docs[c] for c in keep], docs[text].alias("__text")).mapInArrow(run, schema)
