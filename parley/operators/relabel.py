"""Short words that were given to the wrong speaker."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PairConfig
from .intervals import neighbour_votes


def relabel_once(words: DataFrame, target: str, cfg: PairConfig) -> DataFrame:
    """Every short word is judged on the labels that came in; adds `relabelled`."""
    v = neighbour_votes(words, target, cfg.reassign_window)
    change = (~F.col("speaker").eqNullSafe(target)) & (F.length(F.trim("text")) <= cfg.short_word) & (F.col("target_votes") * 2 > F.col("votes"))
    return v.withColumns({"relabelled": change, "speaker": F.when(change, target).otherwise(F.col("speaker"))}).drop("votes", "target_votes")


def reid_span(start, end, pad: float = 0.05) -> tuple[float, float]:
    """What is heard to identify a word's speaker again: some more on both sides, never nothing."""
    start = max(0.0, (start or 0.0) - pad)
    return start, max(start + 0.01, float(end or start) + pad)


def with_pieces(words: DataFrame, window: float) -> DataFrame:
    """Adds `piece`: a file is cut wherever no word begins for longer than the window, so words of different pieces are no
    neighbours. A null start is 0."""
    at = F.coalesce("start", F.lit(0.0))
    w = W.partitionBy("file_id").orderBy(at, "gpos")
    new = F.coalesce(at - F.lag(at).over(w) > window, F.lit(True)).cast("int")
    return words.withColumn("new", new).withColumn("piece", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("new")


def relabel(words: DataFrame, target: str, cfg: PairConfig, similarity=None) -> DataFrame:
    """In word order, a change counts as a vote for the words after it; `similarity(file_id, start, end)` of a word's span may
    refuse one, and does if it fails. Adds `relabelled`.

    Sequential only within a piece of with_pieces(): pieces are dealt out, and only those in which a word could change
    go through Python. Neighbours are found by bisection."""
    window, short, reid, sure = cfg.reassign_window, cfg.short_word, cfg.reid_threshold, cfg.reid_override
    columns = words.columns

    def allowed(f, start, end) -> bool:
        try:
            sim = similarity(f, *reid_span(start, end))
            return sim >= reid or sim > sure
        except Exception:  # noqa: BLE001 - whatever the model raises, the word stays as it is
            return False

    def mend(file_id, starts: list, ends: list, texts: list, speaker: list) -> list[bool]:
        """Which words of a piece, given in word order, become the target's."""
        order = sorted(range(len(starts)), key=starts.__getitem__)
        times, place, changed = [starts[i] for i in order], {i: k for k, i in enumerate(order)}, [False] * len(starts)
        votes = [0] * (len(starts) + 1)  # Fenwick tree of target words in order of time

        def add(k):
            k += 1
            while k < len(votes):
                votes[k] += 1
                k += k & -k

        def upto(k):
            n = 0
            while k:
                n += votes[k]
                k -= k & -k
            return n

        for i, s in enumerate(speaker):
            if s == target:
                add(place[i])
        for i, text in enumerate(texts):
            if speaker[i] == target or len((text or "").strip()) > short:
                continue
            a, b = bisect.bisect_left(times, starts[i] - window), bisect.bisect_right(times, starts[i] + window)
            while a > 0 and abs(times[a - 1] - starts[i]) <= window:
                a -= 1
            while a < b and abs(times[a] - starts[i]) > window:
                a += 1
            while b < len(times) and abs(times[b] - starts[i]) <= window:
                b += 1
            while b > a and abs(times[b - 1] - starts[i]) > window:
                b -= 1
            if 2 * (upto(b) - upto(a)) > b - a and (similarity is None or allowed(file_id, starts[i], ends[i])):
                speaker[i], changed[i] = target, True
                add(place[i])
        return changed

    def mended(pdf: pd.DataFrame) -> pd.DataFrame:
        """Whole pieces, one after another."""
        new = ((pdf["file_id"] != pdf["file_id"].shift()) | (pdf["piece"] != pdf["piece"].shift())).to_numpy()
        cuts = [*new.nonzero()[0].tolist(), len(pdf)]
        files, starts, texts, speaker = pdf["file_id"].tolist(), pdf["start"].fillna(0.0).tolist(), pdf["text"].tolist(), pdf["speaker"].tolist()
        ends = [None if e != e else e for e in pdf["end"].tolist()]
        changed = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            changed += mend(files[a], starts[a:b], ends[a:b], texts[a:b], speaker[a:b])
        speaker = pd.Series([target if c else s for c, s in zip(changed, speaker, strict=True)], index=pdf.index, dtype=object)
        return pdf.assign(speaker=speaker, relabelled=changed)[[*columns, "relabelled"]]

    def run(frames):
        """Rows come sorted by piece; the last one of a batch may go on in the next."""
        rest = None
        for pdf in frames:
            pdf = pdf.astype({c: object for c, kind in pdf.dtypes.items() if pd.api.types.is_string_dtype(kind)})
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if len(pdf):
                last = (pdf["file_id"] == pdf["file_id"].iloc[-1]) & (pdf["piece"] == pdf["piece"].iloc[-1])
                if not last.all():
                    yield mended(pdf[~last])
                rest = pdf[last]
        if rest is not None:
            yield mended(rest)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema) + ", relabelled boolean"
    by_piece = W.partitionBy("file_id", "piece")
    can = ~F.col("speaker").eqNullSafe(target) & (F.length(F.trim(F.coalesce("text", F.lit("")))) <= short)
    rows = with_pieces(words, window).withColumns({"could": F.max(can).over(by_piece), "heard": F.max(F.col("speaker").eqNullSafe(target)).over(by_piece)})
    still = rows.filter("NOT (could AND heard)").select(*columns, F.lit(False).alias("relabelled"))
    moving = rows.filter("could AND heard").drop("could", "heard")
    return still.unionAll(moving.repartition("file_id", "piece").sortWithinPartitions("file_id", "piece", "gpos").mapInPandas(run, schema))
