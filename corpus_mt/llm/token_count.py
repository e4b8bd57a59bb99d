"""Token counts of whole texts, and their packed ids, by a public tokenizer.

Batches reach Python through Arrow.  A text is cut at white space, where the tokenizer
can't join what stands on either side, so a long text never becomes one long call; every
different chunk of a batch goes through the library once, in calls balanced by bytes, and a
bounded cache per worker remembers it.  Only lengths leave the function.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_mt.llm.common import worker_state

LIMIT = 2048
# Characters of one call into the library.
CALL_CHARS = 16_384
# Entries a worker's caches hold at most (about 200 bytes each), and the longest chunk kept.
CHUNKS, PIECES, LONGEST = 600_000, 400_000, 64

# Chunks of these characters alone have the same lower case, normal form and classes in
# every Unicode version, so their pieces can be found here.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# --- fixed values: the words of the lower-case BPE file, and what its word-final tokens end in ---
WORD_END = "</w>"
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# ---------------------------------------------------------------------------------------


class WordTokens:
    """Ids of a tokenizer that drops white space, by white-space chunk.

    Ids are held as little-endian unsigned 32-bit numbers, so those of a text are the
    chunks' bytes joined.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            parts = text.replace("\n", " ").split(" ")
            known = self.chunks
            try:
                yield b"".join([known[p] for p in parts])
            except KeyError:
                yield b"".join(map(self._learn(parts).__getitem__, parts))

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        if len(self.chunks) > CHUNKS:
            self.chunks.clear()
        wanted = set(parts)
        new = [p for p in wanted if p not in self.chunks]
        plain = {p: _PIECE.findall(p.lower()) for p in new if "<|" not in p and _PLAIN.fullmatch(p)}
        rest = [p for p in new if p not in plain]
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        missing = list({w for words in plain.values() for w in words if w not in self.pieces})
        self.pieces.update(zip(missing, self._encode_words(missing), strict=True))
        found = {p: b"".join(map(self.pieces.__getitem__, words)) for p, words in plain.items()}
        found |= zip(rest, self._encode_each(rest), strict=True)
        self.chunks.update((p, b) for p, b in found.items() if len(p) <= LONGEST)
        for w in [w for w in missing if len(w) > LONGEST]:
            del self.pieces[w]
        return {p: found[p] if p in found else self.chunks[p] for p in wanted}

    def _calls(self, words: list[str]) -> Iterator[list[str]]:
        call, size = [], 0
        for w in words:
            call.append(w)
            size += len(w) + 1
            if size > CALL_CHARS:
                yield call
                call, size = [], 0
        if call:
            yield call

    def _encode_each(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for call in self._calls(parts):
            encoded = self.library.encode_batch_fast(call, add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of single words, many to a call: the last token of a word is marked as such."""
        out: list[bytes] = []
        for call in self._calls(words):
            e = self.library.encode_batch_fast([" ".join(call)], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            stops = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(stops) == len(call) and stops[-1] == len(ids):
                out += [ids[a:b].tobytes() for a, b in zip([0, *stops], stops, strict=False)]
            else:
                out += self._encode_each(call)
        return out


class WholeTokens:
    """Ids of any other tokenizer, whole texts at a time."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda text: library.encode(text, num_threads=1)
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            self.encode = lambda text: library.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            yield np.array(self.encode(text), "<u4").tobytes()


def load_tokens(path: str) -> WordTokens | WholeTokens:
    """The tokenizer at ``path``, one per worker; the path is the same on every machine."""

    def make() -> WordTokens | WholeTokens:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            with open(path) as f:
                rules = json.load(f)
            lower = {"type": "Lowercase"} in (rules.get("normalizer") or {}).get("normalizers", [])
            steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
            if lower and [s["pattern"] for s in steps if s["type"] == "Split" and s["behavior"] == "Removed"] == [{"Regex": SPLIT_RULE}]:
                return WordTokens(path)
        return WholeTokens(path)

    return worker_state(f"tokens:{path}", make)


def count_tokens(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row, without moving any.

    Null text counts as empty (0 bytes, 0 tokens).  Null and repeated keys are kept as they
    are, one row out for each row in; other columns play no part, whatever their names.  An
    empty table gives an empty result.  A text of any length is counted whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load_tokens(path)
        for batch in batches:
            texts = (s.as_py() or "" for s in batch.column(1))
            n = np.fromiter((len(b) // 4 for b in tokens.ids(texts)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], ["key", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), size.alias("n_bytes"))
    counted = rows.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
