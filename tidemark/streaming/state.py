"""Streams whose state lies in RocksDB: on local disk, checkpointed to the shared folder as changes."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def on_rocksdb(writer: DataStreamWriter, once: bool = True) -> StreamingQuery:
    """Start a stream on RocksDB state; ``once`` stops it after what is available.

    A stream copies the session's settings when it starts, so others keep theirs.
    """
    conf = writer._spark.conf
    before = {k: conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            conf.set(k, v)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
