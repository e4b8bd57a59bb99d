"""Translations back into their documents while both keep arriving.

A document and its translations meet in the state of the document's id, in whatever order they come.  The state
holds the document and the translations so far, never more than one document's; once the last one is in, the document
goes out and its state is dropped.  A document that waits too long goes out with what there is.

What waits may be more than the executors' memory: it is held packed, and with ``STATE_CONF`` on their disks.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpus_mt.functions.text import MISSING
from corpus_mt.operators.replace import _replace_by_automaton

OUTPUT = "doc_id string, translated string, substr_tlt array<string>, complete boolean"
# The document packed, the number of its substrings (-1 before it is in), the translations packed.
STATE = "doc binary, places int, found binary"
# To start a query with: state in a bounded part of the memory and on disk, few versions of it, and Arrow batches of few documents.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def arrivals(docs: DataFrame, translations: DataFrame) -> DataFrame:
    """One stream of both: templated documents (``doc_id, text, sub_strs``) and ``doc_id, pos, translated``."""
    body = F.to_json(F.struct(F.col("text"), F.col("sub_strs")), {"ignoreNullFields": "false"})
    none = F.lit(None)
    left = docs.select("doc_id", body.alias("doc"), none.cast("int").alias("pos"), none.cast("string").alias("translated"))
    right = translations.select("doc_id", none.cast("string").alias("doc"), F.col("pos").cast("int").alias("pos"), "translated")
    return left.unionByName(right)


def finish_document(doc: dict, found: dict[int, str | None]) -> tuple[str, list[str]]:
    """The document's text with every translated substring replaced, and the translations in order."""
    subs = doc.get("sub_strs") or []
    pairs = [(subs[p], found[p]) for p in sorted(found) if 0 <= p < len(subs) and subs[p] and found[p] is not None]
    if not doc.get("text"):
        return MISSING, [MISSING]
    if not pairs:
        return doc["text"], [MISSING]
    return _replace_by_automaton(doc["text"], [k for k, _ in pairs], [v for _, v in pairs]), [v for _, v in pairs]


def _pack(value) -> bytes:
    return zlib.compress(json.dumps(value, ensure_ascii=False).encode("utf-8", "surrogatepass"), 1)


def _unpack(packed: bytes):
    return json.loads(zlib.decompress(packed).decode("utf-8", "surrogatepass"))


def pack_document(doc: dict) -> bytes:
    """A document whose substrings are places of its text, where they are found in it one behind the other."""
    text, subs, at = doc.get("text"), [], 0
    for s in doc.get("sub_strs") or []:
        start = text.find(s, at) if text and s else -1
        if start >= 0:
            subs += (start, len(s))
            at = start
        else:
            subs += (-1, s)
    return _pack([text, subs])


def unpack_document(packed: bytes) -> dict:
    text, subs = _unpack(packed)
    return {"text": text, "sub_strs": [s if at < 0 else text[at : at + s] for at, s in zip(subs[::2], subs[1::2], strict=True)]}


def _keeper(wait_ms: int | None):
    """What is done with the arrivals of one document; the state is the document and its translations, packed."""

    def out(key: tuple, doc: bytes, found: dict[int, str | None], complete: bool) -> pd.DataFrame:
        text, values = finish_document(unpack_document(doc), found)
        return pd.DataFrame({"doc_id": [key[0]], "translated": [text], "substr_tlt": [values], "complete": [complete]})

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        doc, places, found = None, -1, {}
        if state.exists:
            held_doc, places, held = state.get
            doc = bytes(held_doc) if places >= 0 else None
            found = {int(p): t for p, t in _unpack(bytes(held)).items()}
        if state.hasTimedOut:
            state.remove()
            if doc is not None:
                yield out(key, doc, found, False)
            return
        for frame in frames:
            for body, pos, text in zip(frame["doc"], frame["pos"], frame["translated"], strict=True):
                if not pd.isna(body):
                    doc = json.loads(body)
                    places, doc = len(doc.get("sub_strs") or []), pack_document(doc)
                elif not pd.isna(pos):
                    text = None if pd.isna(text) else text
                    known = found.get(int(pos))
                    # Of several translations of one place the least counts, as in a batch.
                    found[int(pos)] = text if known is None else known if text is None else min(known, text)
        if doc is not None and all(p in found for p in range(places)):
            if state.exists:
                state.remove()
            yield out(key, doc, found, True)
            return
        state.update((doc or b"", places, _pack(found)))
        if wait_ms is not None:
            state.setTimeoutDuration(wait_ms)

    return keep


def replace_stream(docs: DataFrame, translations: DataFrame, wait_ms: int | None = None) -> DataFrame:
    """``doc_id, translated, substr_tlt, complete`` of every document, as soon as all its substrings have their translations.

    Both sides are streams.  A null translation counts as arrived and leaves its substring as it is.  Ids are unique among
    documents; rows without an id are left out.  With ``wait_ms`` a document goes out that long after its last
    arrival even if translations are missing (``complete`` is false then), and translations whose document never came are
    dropped; such a query is run with a trigger by time, as Spark looks for ended waits in one batch after the other.  Without it
    what has not met waits on, and a query may stop once all files are read.  Start it with ``STATE_CONF`` (``write_stream`` takes
    it): Spark's own choice holds all that waits in the executors' heaps.
    """
    rows = arrivals(docs, translations).filter(F.col("doc_id").isNotNull())
    timeout = GroupStateTimeout.NoTimeout if wait_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return rows.groupBy("doc_id").applyInPandasWithState(_keeper(wait_ms), OUTPUT, STATE, "append", timeout)
