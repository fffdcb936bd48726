"""Custom stateful operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.config import Settings, micros
from tradewind.operators.visits import entry_page, flagged_new, replaced, tiled_events

# Keeps microseconds when a row is carried through state as JSON text.
_JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _decider(steps: int, within: int):
    """The per-(bucket of devices, tile) function; self-contained, so it ships by value."""

    def verdict(pending, at):
        """What becomes of the entry page at ``at``, and the time that settles it."""
        start = pending[at][0]
        for step in range(1, steps + 1):
            if at + step == len(pending) or pending[at + step][0] - start >= within:
                return "timeout", start + within
            if not pending[at + step][2]:
                return None, pending[at + step][0]
        return "matched", pending[at + steps][0]

    def decide(key, frames, state):
        from itertools import groupby

        import pandas as pd

        pending = list(zip(*state.get, strict=True)) if state.exists else []
        for pdf in frames:
            columns = [pdf[c].tolist() for c in ("m", "t", "k", "e", "head", "row")]
            columns[2] = [[int(i) for i in ids] for ids in columns[2]]
            pending += zip(*columns, strict=True)
        pending.sort(key=lambda p: (p[0], p[1], list(p[2])))
        watermark = state.getCurrentWatermarkMs()

        rows, reasons, left, next_due = [], [], [], None
        for _, group in groupby(pending, key=lambda p: p[0]):
            whole = list(group)
            mine, done = [p[1:] for p in whole], 0
            for at, (t, _, _, head, row) in enumerate(mine):
                outcome, due = verdict(mine, at) if head else (None, t)
                if due > watermark * 1000:
                    next_due = due if next_due is None else min(due, next_due)
                    break
                if outcome:
                    rows.append(row)
                    reasons.append(outcome)
                done = at + 1
            left += whole[done:]

        if left:
            state.update(tuple(list(column) for column in zip(*left, strict=True)))
            # A timer fires once the watermark is above it, in whole milliseconds.
            state.setTimeoutTimestamp(max((next_due - 1) // 1000, watermark, 1))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame({"row": rows, "reason": reasons})

    return decide


def streaming_bounces(
    pages: DataFrame,
    settings: Settings,
    *,
    mid: str,
    last_page: str,
    time: str,
    tiebreak: Sequence[str],
    tile: timedelta,
) -> DataFrame:
    """Bounces on a watermarked stream, decided as soon as the watermark allows.

    State is kept per time tile and bucket of devices and is gone once the tile is past, so
    it is bounded by the watermark delay and a busy device's history is never held together.
    Buckets (``settings.state_buckets`` by hash) bound the calls, each of which costs
    milliseconds however few rows it has. ``tiebreak`` columns must be integers.
    """
    head = entry_page(last_page) & ~F.col("_probe")
    ids = F.array(*(F.col(c).cast("bigint") for c in tiebreak)).cast("array<bigint>")
    row = F.to_json(F.struct(*pages.columns), _JSON_TIMES)
    keyed = (
        tiled_events(pages, time, settings.bounce_within, tile)
        .withColumn("_mid", F.col(mid))
        .filter(F.col("_mid").isNotNull())
        .select(
            F.pmod(F.xxhash64("_mid"), F.lit(settings.state_buckets)).alias("_bucket"),
            "_tile",
            F.col("_mid").cast("string").alias("m"),
            F.col(time).alias("rowtime"),
            F.unix_micros(time).alias("t"),
            ids.alias("k"),
            entry_page(last_page).alias("e"),
            head.alias("head"),
            F.when(head, row).alias("row"),
        )
    )
    decided = keyed.groupBy("_bucket", "_tile").applyInPandasWithState(
        _decider(settings.bounce_times - 1, micros(settings.bounce_within)),
        "row string, reason string",
        "m array<string>, t array<bigint>, k array<array<bigint>>, e array<boolean>, "
        "head array<boolean>, row array<string>",
        "append",
        "EventTimeTimeout",
    )
    return decided.select(
        F.from_json("row", pages.schema, _JSON_TIMES).alias("_r"), "reason"
    ).select("_r.*", "reason")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def need_rocksdb(spark: SparkSession) -> None:
    """Queries started from here on keep their state in RocksDB, which keyed state of several
    kinds needs; queries that run, or are started again, keep the store they have."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _first_seen():
    """The processor that tells a device's first row; self-contained, so it ships by value."""
    from pyspark.sql.streaming import StatefulProcessor

    class FirstSeen(StatefulProcessor):
        def init(self, handle):
            self.seen = handle.getValueState("seen", "seen boolean")

        def handleInitialState(self, key, initialState, timerValues):
            self.seen.update((True,))

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            known, best = self.seen.exists(), None
            for pdf in rows:
                later = []
                for t, k, row in zip(pdf["t"], pdf["k"], pdf["row"], strict=True):
                    # A row without a time comes after those with one.
                    own = ((pd.isna(t), 0 if pd.isna(t) else t, [int(i) for i in k]), row)
                    if not known and (best is None or own[0] < best[0]):
                        best, own = own, best
                    if own is not None:
                        later.append(own[1])
                if later:
                    yield pd.DataFrame({"row": later, "is_first": False})
            if best is not None:
                self.seen.update((True,))
                yield pd.DataFrame({"row": [best[1]], "is_first": [True]})

        def close(self):
            pass

    return FirstSeen()


def streaming_new_visitors(
    logs: DataFrame, *, mid: str, flag: str, time: str, tiebreak: Sequence[str], seen: DataFrame | None
) -> DataFrame:
    """New-visitor repair on a stream, one value of keyed state for each device.

    A batch looks up the devices it holds and no others. Records not flagged new pass
    without touching the state. Of a device's first batch the earliest record stays new.
    ``seen`` (column ``mid``) fills the state when the query first starts. ``tiebreak``
    columns must be integers.
    """
    need_rocksdb(logs.sparkSession)
    ids = F.array(*(F.col(c).cast("bigint") for c in tiebreak)).cast("array<bigint>")
    keyed = logs.filter(flagged_new(mid, flag)).select(
        F.col(mid).alias("_mid"), F.unix_micros(time).alias("t"), ids.alias("k"),
        F.to_json(F.struct(*logs.columns), _JSON_TIMES).alias("row"),
    )
    known = None if seen is None else seen.select(F.col("mid").alias("_mid")).filter("_mid IS NOT NULL").distinct().groupBy("_mid")
    told = keyed.groupBy("_mid").transformWithStateInPandas(
        _first_seen(), "row string, is_first boolean", "Append", "None", known
    )
    found = told.select(F.from_json("row", logs.schema, _JSON_TIMES).alias("_r"), "is_first").select("_r.*", "is_first")
    fixed = F.when(F.col("is_first"), F.col(flag)).otherwise(F.lit("0"))
    repaired = replaced(found, flag, fixed).select(*logs.columns)
    return logs.filter(~flagged_new(mid, flag)).unionByName(repaired)


def _last_images(order: Sequence[str]):
    """The per-bucket function that gives each change of a key the image before it."""
    order = list(order)

    def follow(key, frames, state):
        import pandas as pd

        images = dict(zip(*state.get, strict=True)) if state.exists else {}
        changes = {}
        for pdf in frames:
            columns = [pdf[c].tolist() for c in ("_key", "new", *order)]
            for k, new, *place in zip(*columns, strict=True):
                changes.setdefault(k, []).append((place, None if pd.isna(new) else new))
        told = []
        for k, mine in changes.items():
            mine.sort(key=lambda c: [(pd.isna(p), 0 if pd.isna(p) else p) for p in c[0]])
            before = images.get(k)
            for place, new in mine:
                told.append((*place, before, new))
                before = new
            if before is None:
                images.pop(k, None)
            else:
                images[k] = before
        if images:
            state.update((list(images), list(images.values())))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(told, columns=[*order, "old", "new"])

    return follow


def streaming_last_images(
    changes: DataFrame, order: Sequence[str], buckets: int = Settings.state_buckets
) -> DataFrame:
    """Changes (_key, order columns, _new) with the key's image before each, as ``_old``.

    Last images are keyed state, held by hash buckets of keys: a call costs milliseconds
    however few keys it has, and a batch reads and writes the buckets of its keys. A deleted
    key has no image. ``order`` names whole-number columns. A bucket's changes of one batch
    are held together while each key's are put in order.
    """
    need_rocksdb(changes.sparkSession)
    image = "map<string,string>"
    rows = changes.select(
        F.pmod(F.xxhash64("_key"), F.lit(buckets)).alias("_bucket"), "_key",
        *(F.col(c).cast("bigint") for c in order), F.to_json("_new").alias("new"),
    )
    kinds = ", ".join(f"`{c}` bigint" for c in order)
    told = rows.groupBy("_bucket").applyInPandasWithState(
        _last_images(order), f"{kinds}, old string, new string",
        "keys array<string>, images array<string>", "append", "NoTimeout",
    )
    return told.select(
        *(F.col(c).cast(changes.schema[c].dataType) for c in order),
        F.from_json("old", image).alias("_old"), F.from_json("new", image).alias("_new"),
    )
