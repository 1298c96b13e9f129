"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A window is the shortest run of lines, from any line on, that has `lines` lines or `chars` characters; so a long line
is a window of its own. Winnowing: each window selects its least line hash, and only these minima are written, as
the fingerprints of their texts. Two places that share a window share its fingerprint for certain, so texts whose
fingerprints all stand at one place end here. Around the positions of the others the match is extended both ways,
over every window that selected that line: a window that stands at an earlier place as well is a repeated run, and
overlapping ones add up to repeats of any length, of which all but the first are deleted.

Groups are only ever aggregated (first place), so a line that a third of all documents have costs one row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.shared import BROADCAST_BYTES, looked_up, small, stored

#: The least repeat: so many lines, or so many characters in fewer; a text that has neither is one window.
LINES, CHARS = 4, 40
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every column of docs as _row, its key (_d, _t) and its lines; null and empty texts have none."""
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_d"), F.xxhash64(text).alias("_t"), text.alias("_text"))
    return keyed.withColumn("_lines", F.when(F.coalesce(F.col("_text"), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("_text", "\n", -1)))


def _hashed(keyed: DataFrame) -> DataFrame:
    """(_d, _t, _l): of each line of the texts that have any its length and two hashes of 64 bits."""
    return keyed.where(F.coalesce(F.col("_text"), F.lit("")) != "").select("_d", "_t", F.expr("transform(_lines, x -> named_struct('n', length(x), 'a', xxhash64(x), 'b', xxhash64(1, x)))").alias("_l"))


def _window_length(lines: int, chars: int) -> str:
    """SQL for the lines of the window from line i on; beyond the end of the text if it has too few."""
    cases = " ".join(f"WHEN {' + '.join(f'get(_l, i + {k}).n' for k in range(n))} >= {chars} THEN {n}" for n in range(1, lines))
    return f"(CASE {cases} ELSE {lines} END)" if cases else str(lines)


def _windowed(hashed: DataFrame, lines: int, chars: int, runs: bool) -> DataFrame:
    """Adds _w, the windows of a text: first line i, lines n, m (the least line hash a, with its line p), and two hashes of the run.

    All that needs the text's lines is worked out before the windows become rows, so a text costs its lines once.
    explode_outer() keeps the optimizer from asking for the windows a second time, in a filter.
    """
    every = f"filter(transform(sequence(0, size(_l) - 1), i -> named_struct('i', i, 'n', {_window_length(lines, chars)})), w -> w.i + w.n <= size(_l))"
    whole = "array(named_struct('i', 0, 'n', size(_l)))"
    run = "slice(_l, w.i + 1, w.n)"
    fields = [f"'i', w.i, 'n', w.n, 'm', array_min(transform({run}, (x, k) -> named_struct('a', x.a, 'p', w.i + k)))"]
    fields += [f"'{c}', xxhash64(transform({run}, x -> x.{c}), w.n)" for c in "ab" if runs]
    every = hashed.withColumn("_w", F.expr(every)).withColumn("_w", F.expr(f"CASE WHEN size(_w) = 0 THEN {whole} ELSE _w END"))
    return every.withColumn("_w", F.expr(f"transform(_w, w -> named_struct({', '.join(fields)}))"))


def _minima() -> Column:
    """The fingerprints of a text's windows, each place once: neither ends of successive windows nor their least lines ever go back."""
    return F.expr("transform(filter(_w, (w, k) -> k = 0 OR w.m.p <> get(_w, k - 1).m.p), w -> w.m.a)")


def _spans(keyed: DataFrame, lines: int, chars: int, broadcast_bytes: int) -> DataFrame:
    """(_d, _t, _run, _from, _to): of each text with any, the line ranges that later repeats cover, in order and apart."""
    hashed = _hashed(keyed)
    minima = _windowed(hashed, lines, chars, False).select("_d", "_t", F.explode_outer(_minima()).alias("_f"))
    minima = stored(minima, "fingerprints")
    repeated = small(stored(minima.groupBy("_f").agg(F.count("*").alias("_n")).where("_n > 1").select("_f"), "repeated"), broadcast_bytes)
    texts = stored(minima.join(repeated, "_f").select("_d", "_t").distinct(), "texts")
    places = _windowed(hashed.join(small(texts, broadcast_bytes), ["_d", "_t"]), lines, chars, True).select("_d", "_t", F.explode_outer("_w").alias("_w"))
    near = places.select("_d", "_t", F.col("_w.i").alias("_i"), F.col("_w.n").alias("_n"), F.col("_w.m.a").alias("_f"), F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b"))
    near = stored(near.join(repeated, "_f"), "matches")
    place = F.struct("_d", "_t", "_i")
    first = near.groupBy("_f", "_a", "_b").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where("_first <> _last").drop("_last")
    later = looked_up(near, first, ["_f", "_a", "_b"], "first_runs", broadcast_bytes=broadcast_bytes).where(place > F.col("_first"))
    later = later.groupBy("_d", "_t", "_i").agg(F.max(F.col("_i") + F.col("_n")).alias("_to"))
    before = Window.partitionBy("_d", "_t").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    later = later.withColumn("_new", F.when(F.col("_i") <= F.max("_to").over(before), 0).otherwise(1))
    later = later.withColumn("_run", F.sum("_new").over(Window.partitionBy("_d", "_t").orderBy("_i")))
    return later.groupBy("_d", "_t", "_run").agg(F.min("_i").alias("_from"), F.max("_to").alias("_to"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES, chars: int = CHARS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of docs: id, n_lines, n_removed, kept_text (the lines that stay, in order).

    A run of `lines` lines, or of fewer that have `chars` characters, or a whole text that is shorter than both, goes
    if the same run starts at a smaller (id, line) anywhere in the input; runs are judged as they stand there. Lines
    are compared by 128 bits of hashes; blank ones are lines. Null and empty texts have no lines and give an empty
    text; ids are whole numbers (others are cast to long) and a null id is smaller than any other; rows with one id
    are told apart by their text, and rows that repeat both are judged alike. An empty table gives no rows. Other
    columns of docs are ignored.
    """
    kept = _kept(docs, id_col, text_col, lines, chars, broadcast_bytes)
    return kept.select(F.col("_id").alias(id_col), "n_lines", "n_removed", "kept_text")


def _kept(docs: DataFrame, id_col: str, text_col: str, lines: int, chars: int, broadcast_bytes: int) -> DataFrame:
    keyed = _keyed(docs, id_col, text_col)
    gone = _spans(keyed, lines, chars, broadcast_bytes).groupBy("_d", "_t").agg(F.array_sort(F.collect_list(F.struct("_from", "_to"))).alias("_gone"), F.sum(F.col("_to") - F.col("_from")).alias("_removed"))
    joined = keyed.join(small(stored(gone, "deleted"), broadcast_bytes, "shuffle_hash"), ["_d", "_t"], "left")
    # The lines between two deleted ranges are a slice, so a text costs its lines and its ranges, not their product.
    between = "transform(sequence(0, size(_gone)), k -> slice(_lines, coalesce(get(_gone, k - 1)._to, 0) + 1, coalesce(get(_gone, k)._from, size(_lines)) - coalesce(get(_gone, k - 1)._to, 0)))"
    kept = F.when(F.col("_gone").isNull(), F.coalesce("_text", F.lit(""))).otherwise(F.array_join(F.flatten(F.expr(between)), "\n"))
    return joined.select("_row", "_id", F.size("_lines").cast("long").alias("n_lines"), F.coalesce("_removed", F.lit(0)).cast("long").alias("n_removed"), kept.alias("kept_text"))


def deduplicated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str | None = "n_chars",
    lines: int = LINES,
    chars: int = CHARS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """docs with the lines that stay as texts (and chars_col, if docs has it, brought up to date); a text that lost every line goes.

    Rows that lost nothing are as they were, null and empty texts included.
    """
    kept = _kept(docs, id_col, text_col, lines, chars, broadcast_bytes).where("n_removed < n_lines or n_lines = 0")
    new = {text_col: F.col("kept_text"), chars_col: F.length("kept_text").cast("long")}
    of = lambda c: F.col("_row").getField(c)
    return kept.select(*(F.when(F.col("n_removed") > 0, new[c]).otherwise(of(c)).alias(c) if c in new else of(c).alias(c) for c in docs.columns))
