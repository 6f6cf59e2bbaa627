"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the characters cuts each text where the last ``WINDOW`` characters say so, so
passages that documents share give equal chunks wherever they stand. A worker encodes a chunk once
and keeps its ids in a cache of bounded size. At each join between two chunks the text around the
cut is encoded anew, from whole pieces left of it to whole pieces right of it, and the new ids must
agree with the ids of both chunks at the two ends; else the stretch grows, at last to both whole
chunks or the whole text.

Defined results: a null or empty text has no ids; a text of any length is one row; equal rows give
equal results; only the key and text columns are read, so other columns may have any name. Strings of
special tokens inside a text become the special id, as the tokenizers library does by default.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import documents, keyed_text, map_slices, tidy, worker_cache

#: Characters that decide about a cut, and the average number of characters between cuts.
WINDOW, AVERAGE = 16, 2048
#: Characters of chunks in one half of a worker's cache.
CACHE_CHARS = 4_000_000
#: White space after one of these characters is a border between pieces of any text around it.
_BORDER = re.compile(r"(?<=[!-~À-ÿ])[ \n]")
_PIECES = 4
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def first_borders(text: str, start: int, end: int) -> list[int]:
    return [m.start() for m in islice(_BORDER.finditer(text, start, end), _PIECES)]


def last_borders(text: str) -> list[int]:
    reach = 64
    while True:
        start = max(0, len(text) - reach)
        found = [m.start() for m in _BORDER.finditer(text, start)]
        if len(found) >= _PIECES or not start:
            return found[-_PIECES:]
        reach *= 8


def cut_text(text: str, window: int = WINDOW, average: int = AVERAGE) -> list[str]:
    """Chunks whose borders depend on the ``window`` (a power of two) characters before them only.

    A chunk with fewer than ``_PIECES`` borders between pieces goes on to the next cut.
    """
    if len(text) <= average:
        return [text] if text else []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    hashed, reach, factor = codes, 1, np.array([_FACTOR])
    while reach < window:  # from hashes of 1 character to those of 2, 4, 8 ...
        hashed = hashed[:-reach] * factor + hashed[reach:]
        reach, factor = 2 * reach, np.multiply(factor, factor, dtype=np.uint64)
    hashed ^= hashed >> np.uint64(29)
    hashed *= _FACTOR
    cuts = (np.flatnonzero(hashed < np.uint64(2**64 // average)) + window).tolist()
    chunks, start = [], 0
    for cut in cuts:
        if cut < len(text) and len(first_borders(text, start, cut)) == _PIECES:
            chunks.append(text[start:cut])
            start = cut
    if chunks and len(first_borders(text, start, len(text))) < _PIECES:
        start -= len(chunks.pop())
    return [*chunks, text[start:]]


class Codec:
    """Ids of texts by a byte-level BPE file of the tokenizers library, and back."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        if said["model"]["type"] != "BPE" or said["pre_tokenizer"]["type"] != "ByteLevel" or said["normalizer"]:
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        if said["pre_tokenizer"].get("add_prefix_space") or not said["pre_tokenizer"].get("use_regex", True):
            raise ValueError("a file that adds a space before texts, or splits them without the usual pattern, is not supported")
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        # The library's letters for bytes: printable ones stand for themselves, the rest follow from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
        ranks = {bytes(letters[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in self.special}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.engine = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(self.special))
        self.width = {i: len(token) for token, i in ranks.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.room = CACHE_CHARS
        self.encoded = self.reused = 0

    def plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens. Latin text takes the faster engine of the same merges."""
        try:
            text.encode("latin-1")
            usual = text.replace("\n", "").isprintable()
        except UnicodeEncodeError:
            usual = False
        return self.engine.encode_ordinary(text) if usual else self.library.encode(text, add_special_tokens=False).ids

    def chunk(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """(ids, first borders, last borders) of a chunk, encoded once while it stays in the cache."""
        found = self.young.get(text) or self.old.get(text)
        if found is None:
            found = (array("i", self.plain(text)), first_borders(text, 0, len(text)), last_borders(text))  # 4 bytes an id, not 40
            self.encoded += 1
        else:
            self.reused += 1
        if text not in self.young:
            self.room -= len(text)
            if self.room < 0:
                self.old, self.young, self.room = self.young, {}, CACHE_CHARS
            self.young[text] = found
        return found[0].tolist(), *found[1:]

    def covering(self, ids: list[int], size: int, last: bool = False) -> int:
        """How many ids at the front (or end) stand for exactly ``size`` bytes; 0 if no border is there."""
        count = 0
        for i in reversed(ids) if last else ids:
            if size <= 0:
                break
            size -= self.width[i]
            count += 1
        return count if size == 0 else 0

    def joined(self, chunks: list[str]) -> list[int]:
        """Ids of the chunks' joined text."""
        if not chunks:
            return []
        done = chunks[0]  # the text whose ids end ``ids`` and may change at the next join
        ids, _, borders = self.chunk(done)
        for text in chunks[1:]:
            own, own_first, own_last = self.chunk(text)
            for reach in (2, 3, 4):
                if reach > min(len(borders), len(own_first)):
                    continue
                left, inner = borders[-reach], borders[-reach + 1]
                right, outer = own_first[reach - 2], own_first[reach - 1]
                anew = self.plain(done[left:] + text[:outer])
                tail = self.covering(ids, len(done[left:].encode()), last=True)
                edge = self.covering(anew, len(done[left:inner].encode()))
                head = self.covering(own, len(text[:outer].encode()))
                far = self.covering(anew, len(text[right:outer].encode()), last=True)
                if (
                    min(tail, edge, head, far) > 0
                    and anew[:edge] == ids[len(ids) - tail :][:edge]
                    and anew[len(anew) - far :] == own[:head][-far:]
                ):
                    ids[len(ids) - tail :] = anew
                    ids.extend(own[head:])
                    done, borders = text, [b for b in own_last if b >= outer]
                    break
            else:  # no agreement: both stretches become one
                before = self.covering(ids, len(done.encode()), last=True)
                if not before:
                    return self.plain("".join(chunks))
                done += text
                ids[len(ids) - before :] = self.plain(done)
                borders = last_borders(done)
        return ids

    def encode(self, text: str) -> list[int]:
        if self.split is None or not any(s in text for s in self.special):
            return self.joined(cut_text(text))
        ids: list[int] = []
        for part in self.split.split(text):
            ids.extend([self.special[part]] if part in self.special else self.joined(cut_text(part)))
        return ids

    def decode(self, ids: list[int]) -> str:
        """As the library does it: the bytes of all tokens, broken UTF-8 replaced."""
        return self.engine.decode_bytes(ids).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    kept = worker_cache("bpe")
    return kept[("bpe", path)] if ("bpe", path) in kept else kept.setdefault(("bpe", path), Codec(path))


def _with(path: str, work: Callable[[Codec, list], list], column: str, output: str):
    def run(batch: pa.RecordBatch) -> dict:
        own = codec(path)
        return {"doc_id": batch.column("doc_id"), output: work(own, batch.column(column).to_pylist())}

    return run


def encode_documents(df: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``, one row per row of ``df``. No shuffle; rows stay where they are read."""
    rows = keyed_text(df, key, text)
    kind = dict(rows.dtypes)["doc_id"]
    work = _with(tokenizer or default_tokenizer(), lambda c, texts: [c.encode(t) for t in texts], "text", "ids")
    return map_slices(rows, work, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` of rows ``doc_id, ids``."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        own = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # bounded output; a long row alone is one text
                part = batch.slice(start, 256)
                texts = [own.decode(ids) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(tidy(run), f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, text string")


def op4_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again, as digests."""
    return decode_documents(encode_documents(documents(spark, sf_dir))).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
