"""Numbered records of CSV files, read in parallel although a quoted field may hold line breaks.

Whether a line begins a record depends on the lines before it. Each line is summarised by what it does to
the quote state: leave it, end outside or inside quotes whatever it was, or reverse it. Such
summaries compose, so every split is summed up for both states in which it may begin, the splits of a file are
chained, one small row per split, and only then are records cut and numbered. The text is scanned once and
stored; everything else reads columns of the stored lines. Lines are sorted only in splits in which a line is
blank or leaves the state of its quotes open.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vigia.durable import COMPACT, Workspace

# A field is quoted only if it begins with a quote; a doubled quote inside is a quote, and what follows the
# closing quote belongs to the field as it stands. Elsewhere quotes are ordinary characters.
_FIELD_START, _PLAIN, _QUOTED, _AFTER_QUOTE = range(4)
#: Next state after a quote, a comma, other text.
_NEXT = {
    _FIELD_START: (_QUOTED, _FIELD_START, _PLAIN),
    _PLAIN: (_PLAIN, _FIELD_START, _PLAIN),
    _QUOTED: (_AFTER_QUOTE, _QUOTED, _QUOTED),
    _AFTER_QUOTE: (_QUOTED, _FIELD_START, _PLAIN),
}
# What a line does to the state "inside quotes".
_KEEPS, _CLOSES, _OPENS, _REVERSES = range(4)
_SPLIT = ["_archivo", "_bloque"]


def _tokens(text: Column) -> Column:
    """Quotes, commas and what lies between them."""
    return F.regexp_extract_all(text, F.lit('([",]|[^",]+)'), F.lit(1))


def _next_state(state: Column, token: Column) -> Column:
    table = F.array(*[F.lit(s) for row in _NEXT.values() for s in row])
    kind = F.when(token == '"', 0).when(token == ",", 1).otherwise(2)
    return F.get(table, state * 3 + kind)


def _ends_quoted(line: Column, start: int) -> Column:
    return F.aggregate(_tokens(line), F.lit(start), _next_state) == _QUOTED


def _effect(line: Column) -> Column:
    fresh, inside = _ends_quoted(line, _FIELD_START), _ends_quoted(line, _QUOTED)
    with_quotes = F.when(fresh & inside, _OPENS).when(fresh, _REVERSES).when(inside, _KEEPS).otherwise(_CLOSES)
    return F.when(F.contains(line, F.lit('"')), with_quotes).otherwise(_KEEPS)


def fields(record: Column) -> Column:
    """The fields of a record as an array of text."""
    empty = F.array().cast("array<string>")
    start = F.struct(F.lit(_FIELD_START).alias("state"), F.lit("").alias("text"), empty.alias("done"))

    def step(made: Column, token: Column) -> Column:
        state = made["state"]
        ends = (token == ",") & (state != _QUOTED)
        # A quote that opens or closes a field is not part of it.
        silent = (token == '"') & state.isin(_FIELD_START, _QUOTED)
        return F.struct(
            _next_state(state, token).alias("state"),
            F.when(ends, "").when(silent, made["text"]).otherwise(F.concat(made["text"], token)).alias("text"),
            F.when(ends, F.array_append(made["done"], made["text"])).otherwise(made["done"]).alias("done"))

    quoted = F.aggregate(_tokens(record), start, step, lambda made: F.array_append(made["done"], made["text"]))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, ",", -1))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The text lines with their split, their order within it, whether they are blank, and their effect on quotes."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("_archivo"), F.col("_metadata.file_block_start").alias("_bloque"))
    marked = F.when(F.col("_bloque") == 0, F.regexp_replace("value", "^\\x{FEFF}", "")).otherwise(F.col("value"))
    # A task reads the splits packed into it one after the other: within a split the ids ascend.
    return lines.withColumn("value", marked).withColumns({
        "_id": F.monotonically_increasing_id(), "_vacia": F.col("value").rlike(r"^[ \t]*\z"), "_efecto": _effect(F.col("value"))})


def _after(start: Column, order: Window) -> Column:
    """Whether the text is inside quotes after a line, if its split began in the state ``start`` (0 or 1).

    The last line that fixes the state counts, and the reversals since.
    """
    fixed = F.last(F.when(F.col("_efecto") == _CLOSES, 0).when(F.col("_efecto") == _OPENS, 1), ignorenulls=True).over(order)
    since = F.col("_giros") - F.coalesce(F.last(F.when(F.col("_efecto").isin(_CLOSES, _OPENS), F.col("_giros")), ignorenulls=True).over(order), F.lit(0))
    return (F.coalesce(fixed, start) + since) % 2


def _in_split() -> Window:
    """The lines of a split in order; its first id stands for the split, since a path in every sorted row is wide."""
    return Window.partitionBy("_primero").orderBy("_id")


def _with_states(lines: DataFrame, starts: dict[str, Column]) -> DataFrame:
    """For each name and start: ``name`` the state before the line, ``name_fin`` the state after it."""
    order = _in_split()
    turned = lines.withColumn("_giros", F.sum(F.when(F.col("_efecto") == _REVERSES, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    after = turned.withColumns({f"{name}_fin": _after(start, order.rowsBetween(Window.unboundedPreceding, 0)) for name, start in starts.items()})
    return after.withColumns({name: F.coalesce(F.lag(f"{name}_fin").over(order), start) for name, start in starts.items()}).drop("_giros")


def _begins(state: str) -> Column:
    return (F.col(state) == 0) & ~F.col("_vacia")


def _splits(lines: DataFrame, work: Workspace) -> DataFrame:
    """One row per split: the states in which it begins and ends, the records of its file that begin before and in it, and whether its lines are other than one record each."""
    # Where no line is blank or leaves a quote open, counts tell all: begun inside quotes, the first line that closes them ends that.
    unsettled = F.col("_vacia") | F.col("_efecto").isin(_OPENS, _REVERSES)
    counted = work.stored(
        lines.groupBy(*_SPLIT).agg(
            F.count(F.lit(1)).alias("_lineas"), F.min("_id").alias("_primero"), F.max(unsettled).alias("_mezcla"),
            F.min(F.when(F.col("_efecto") == _CLOSES, F.col("_id"))).alias("_cierra")),
        "recuentos")
    # The lines of the other splits are put in order.
    mixed = lines.join(counted.where("_mezcla").select(*_SPLIT, "_primero"), _SPLIT).select("_primero", "_id", "_vacia", "_efecto")
    both = _with_states(mixed, {"_e0": F.lit(0), "_e1": F.lit(1)})
    ordered = both.groupBy("_primero").agg(
        *[F.max_by(f"_e{e}_fin", "_id").alias(f"_fin{e}") for e in (0, 1)],
        *[F.count_if(_begins(f"_e{e}")).alias(f"_n{e}") for e in (0, 1)],
        F.max(F.col("_vacia") | (F.col("_e0") == 1) | (F.col("_e0_fin") == 1)).alias("_partida"))
    closed = F.col("_cierra").isNotNull()
    after_close = F.col("_lineas") - (F.col("_cierra") - F.col("_primero") + 1)
    settled = {
        "_fin0": F.lit(0), "_fin1": F.when(closed, 0).otherwise(1), "_n0": F.col("_lineas"),
        "_n1": F.when(closed, after_close).otherwise(0), "_partida": F.lit(False)}
    summed = counted.join(ordered, "_primero", "left").select(
        *_SPLIT, "_primero", *[F.coalesce(name, value).alias(name) for name, value in settled.items()])
    in_file = Window.partitionBy("_archivo").orderBy("_bloque")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # The same composition over the splits of a file, which begins outside quotes.
    effect = F.when(F.col("_fin0") == F.col("_fin1"), F.when(F.col("_fin0") == 0, _CLOSES).otherwise(_OPENS)).when(F.col("_fin0") == 1, _REVERSES).otherwise(_KEEPS)
    chained = summed.withColumn("_efecto", effect).withColumn("_giros", F.sum(F.when(F.col("_efecto") == _REVERSES, 1).otherwise(0)).over(in_file))
    chained = chained.withColumn("_sale", _after(F.lit(0), in_file)).withColumn("_entra", F.coalesce(F.lag("_sale").over(in_file), F.lit(0)))
    own = F.when(F.col("_entra") == 0, F.col("_n0")).otherwise(F.col("_n1"))
    return chained.withColumn("_propios", own).select(
        *_SPLIT, "_entra", "_sale", "_propios", "_primero", (F.col("_partida") | (F.col("_entra") == 1)).alias("_partida"),
        F.coalesce(F.sum("_propios").over(before), F.lit(0)).alias("_previos"))


@dataclass(frozen=True)
class NumberedRecords:
    """``records``: archivo (path), fila (from 1 in each file) and campos. ``unclosed``: archivo and the fila in which a quote never closes."""

    records: DataFrame
    unclosed: DataFrame


def numbered_records(spark: SparkSession, paths: list[str], work: Workspace) -> NumberedRecords:
    """The records of CSV files, numbered from 1 in each file; blank lines between records do not count.

    Both tables belong to ``work``. A line break inside a field is one ``\\n``. Of a file whose last
    quote never closes, the record it opens is left out and named in ``unclosed``.
    """
    lines = work.stored(_lines(spark, paths), "lineas", codec=COMPACT)
    splits = work.stored(_splits(lines, work), "cortes")
    last = Window.partitionBy("_archivo")
    ends = splits.withColumn("_total", F.sum("_propios").over(last)).withColumn("_ultimo", F.max("_bloque").over(last))
    unclosed = work.stored(
        ends.where((F.col("_bloque") == F.col("_ultimo")) & (F.col("_sale") == 1)).select(F.col("_archivo").alias("archivo"), F.col("_total").alias("fila")),
        "comillas-abiertas")
    met = lines.join(splits, _SPLIT)
    # Where every line of a split is a record its place is its number; only other splits are put in order.
    straight = met.where(~F.col("_partida")).select("_archivo", (F.col("_previos") + F.col("_id") - F.col("_primero") + 1).alias("_fila"), "value")
    states = _with_states(met.where("_partida"), {"_estado": F.col("_entra")})
    order = _in_split().rowsBetween(Window.unboundedPreceding, 0)
    placed = states.withColumn("_fila", F.col("_previos") + F.count_if(_begins("_estado")).over(order))
    alone = _begins("_estado") & (F.col("_estado_fin") == 0)
    whole = placed.where(alone).select("_archivo", "_fila", "value")
    # Lines of records that span several lines, wherever the splits are cut.
    parts = placed.where(((F.col("_estado") == 1) | (F.col("_estado_fin") == 1)))
    parts = parts.join(unclosed.select(F.col("archivo").alias("_archivo"), F.col("fila").alias("_fila")), ["_archivo", "_fila"], "left_anti")
    joined = parts.groupBy("_archivo", "_fila").agg(F.array_sort(F.collect_list(F.struct("_bloque", "_id", "value"))).alias("_partes")).select(
        "_archivo", "_fila", F.array_join(F.transform("_partes", lambda p: F.coalesce(p["value"], F.lit(""))), "\n").alias("value"))
    records = straight.unionByName(whole).unionByName(joined).select(F.col("_archivo").alias("archivo"), F.col("_fila").alias("fila"), fields(F.col("value")).alias("campos"))
    return NumberedRecords(work.stored(records, "registros", (lines, splits), COMPACT), unclosed)
