"""Cleaning, validation, dedup and the quality censuses over staging.

All rules are column expressions. ``tag`` adds the typed fields and the first
reject reason; accepted rows, rejected rows and every census derive from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao import vocab
from balcao.functions import bloom, dates, money
from balcao.functions import text as tx
from balcao.functions.exact import percent
from balcao.session import compiled, written

CLEAN_COLUMNS = [
    "txn_id", "order_id", "sale_date", "customer_id", "product", "category", "unit_price",
    "quantity", "city", "state", "country", "payment_method", "status",
]
#: Typed fields no rule looks at.
_UNJUDGED = ("city", "state", "country")
_MAX_AMOUNT = 10**12


def _carried(staging: DataFrame) -> list[str]:
    """Columns beside the eleven text columns that pass through cleaning, where present."""
    return [c for c in ("ordinal", "malformed") if c in staging.columns]


def _prepared(staging: DataFrame) -> DataFrame:
    """The raw row, each text stripped once, and the intermediate forms parsing uses repeatedly.

    Separate projections: the optimizer merges two only where that repeats no
    costly expression.
    """
    kept = _carried(staging)
    stripped = staging.select(
        *kept,
        F.struct(*vocab.STAGING_COLUMNS).alias("raw"),
        *[tx.strip(F.col(c)).alias(c) for c in vocab.STAGING_COLUMNS if c not in ("unit_price", "location")],
        money.bare_amount(F.col("unit_price")).alias("unit_price"),
        tx.is_blank(F.col("unit_price")).alias("blank_unit_price"),
        tx.location_parts(F.col("location")).alias("parts"),
    )
    return stripped.withColumns(
        {
            "category": tx.strip_accents(F.col("category")),
            "status": tx.strip_accents(F.col("status")),
            "unit_price": money.plain_number(F.col("unit_price")),
            "place": tx.location_of(F.col("parts")),
        }
    )


def _typed() -> dict[str, Column]:
    """Typed fields from prepared text; NULL where unreadable."""
    return {
        "txn_id": F.col("txn_id"),
        "order_id": F.col("order_id"),
        "sale_date": dates.date_of(F.col("sale_date")),
        "customer_id": F.col("customer_id"),
        "product": F.col("product"),
        "category": tx.category_of(F.col("category")),
        "unit_price": money.price_of(F.col("unit_price")),
        "quantity": tx.quantity_of(F.col("quantity")),
        "city": F.col("place.city"),
        "state": F.col("place.state"),
        "country": F.col("place.country"),
        "payment_method": F.col("payment_method"),
        "status": tx.status_of(F.col("status")),
    }


def _reject_reason() -> Column:
    """First failing rule over the typed fields and the marks taken from the text."""
    def typed(name: str) -> Column:
        return F.col(f"clean.{name}")

    rules = [(F.col(f"clean.blank_{f}"), vocab.NULL_KEY + name) for f, name in vocab.KEY_FIELDS.items()]
    rules += [
        (typed("sale_date").isNull(), vocab.BAD_DATE),
        (typed("unit_price").isNull(), vocab.BAD_PRICE),
        (typed("negative"), vocab.NEGATIVE_PRICE),
        (typed("quantity").isNull(), vocab.BAD_QUANTITY),
        (typed("quantity") <= 0, vocab.NON_POSITIVE_QUANTITY),
        (typed("status").isNull(), vocab.BAD_STATUS),
        (typed("category").isNull(), vocab.NULL_CATEGORY),
    ]
    rules += [(typed(f).isNull(), vocab.NULL_REQUIRED + name) for f, name in vocab.REQUIRED_FIELDS.items()]
    rules.append((typed("unit_price") * typed("quantity") >= _MAX_AMOUNT, vocab.AMOUNT_OVERFLOW))
    # coalesce keeps the first label and, unlike a CASE, nests nothing.
    return F.coalesce(*[F.when(test, label) for test, label in rules])


def tag(staging: DataFrame, *columns: str) -> DataFrame:
    """Staging with ``raw`` (the row as it came), ``clean`` (typed) and ``reason`` (NULL if valid).

    A ``malformed`` line, which has no fields, is rejected before every rule.
    Given ``columns``, fields that are neither among them nor judged are not typed.

    The typed fields pass through a one-row generator. Without it the optimizer
    copies every parsing expression into each filter on ``reason`` and then
    reasons over the copies, which takes it minutes.
    """
    compiled(staging.sparkSession)
    prepared = _prepared(staging)
    marks = {f"blank_{f}": F.coalesce(F.col(f), F.lit("")) == "" for f in vocab.KEY_FIELDS if f != "unit_price"}
    # Not from ``raw``, which would then be made for readers without it, too.
    marks["blank_unit_price"] = F.col("blank_unit_price")
    marks["negative"] = money.negative_of(F.col("unit_price"))
    unread = [c for c in _UNJUDGED if columns and c not in columns]
    fields = {**{name: c for name, c in _typed().items() if name not in unread}, **marks}
    kept = _carried(staging)
    typed = prepared.select(*kept, "raw", *[c.alias(f"_{name}") for name, c in fields.items()])
    clean = F.struct(*[F.col(f"_{name}").alias(name) for name in fields])
    rows = typed.select(*kept, "raw", F.explode(F.array(clean)).alias("clean"))
    reason = _reject_reason()
    if "malformed" in kept:
        reason = F.when(F.col("malformed").isNotNull(), vocab.MALFORMED).otherwise(reason)
    return rows.withColumn("reason", reason)


def rejected(tagged: DataFrame) -> DataFrame:
    """Invalid rows as they came, with the reason and, from a CSV feed, the malformed line."""
    kept = [c for c in ("malformed",) if c in tagged.columns]
    return tagged.filter("reason is not null").select("raw", "reason", *kept)


def valid(tagged: DataFrame, *columns: str) -> DataFrame:
    """Valid rows, repeats included, as typed columns with ``ordinal``; of the columns only the id and ``columns``, if given."""
    names = [c for c in CLEAN_COLUMNS if not columns or c == "txn_id" or c in columns]
    return tagged.filter("reason is null").select(*[F.col(f"clean.{c}") for c in names], "ordinal")


def dedup_keep_first(rows: DataFrame) -> DataFrame:
    """First row per transaction id in staging order.

    The engine limits each id to its first row before the shuffle as well as
    after it, so an id repeated without end never gathers in one task.
    """
    first = Window.partitionBy("txn_id").orderBy("ordinal")
    return rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def accepted(tagged: DataFrame) -> DataFrame:
    return dedup_keep_first(valid(tagged))


def accepted_rows(staging: DataFrame, *columns: str) -> DataFrame:
    """``accepted`` of a staging table, or only ``columns`` of it.

    Rows are read and judged once: the valid ones are written, typed and no wider
    than dedup and the columns need, and all further steps read those.
    """
    found = _first_rows(written(valid(tag(staging, *columns), *columns), "valid"))
    return found.select(*columns) if columns else found


def accepted_of(tagged: DataFrame, *columns: str) -> DataFrame:
    """``accepted`` of written tagged rows, or only ``columns`` of it."""
    found = _first_rows(valid(tagged, *columns))
    return found.select(*columns) if columns else found


def _first_rows(rows: DataFrame) -> DataFrame:
    """The first of the written valid rows of each id, moving only the rows whose id repeats."""
    repeats = _seems_repeated(rows)
    if repeats is None:
        return rows
    return rows.filter(~repeats).unionByName(dedup_keep_first(rows.filter(repeats)))


def _seems_repeated(rows: DataFrame) -> Column | None:
    """Whether other written rows may have a row's ``txn_id`` too; None if no id repeats.

    Ids are counted as 64-bit hashes, from the id column alone. A Bloom filter of
    the repeated ones, of bounded size, then parts the table: rows outside it are
    the only ones of their id and stay where they are, and only those inside need
    to move. An id that only seems repeated costs its move; none is missed.
    """
    id_ = F.col("txn_id")
    hashes = rows.filter(id_.isNotNull()).select(F.xxhash64(id_).alias("id"))
    counts = hashes.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    repeated = written(counts.filter("n > 1").select("id"), "repeated-ids")
    n = repeated.count()
    if not n:
        return None
    bits = bloom.size_for(n)
    words = written(bloom.build(repeated, "id", bits), "repeated-filter")
    return bloom.might_hold(words.scalar(), F.xxhash64(id_), bits)


def duplicate_census(staging: DataFrame) -> DataFrame:
    """Rows of a written staging table whose non-null transaction id occurs more than once, per id.

    Only rows that may repeat are counted by id and joined with the counts; hot ids stay mergeable.
    """
    repeats = _seems_repeated(staging)
    rows = staging.filter("txn_id is not null").filter(F.lit(False) if repeats is None else repeats)
    repeated = rows.groupBy("txn_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return rows.select(*vocab.STAGING_COLUMNS).join(repeated, "txn_id")


def load_balance(tagged: DataFrame) -> DataFrame:
    """Staged, valid, rejected, fact and duplicate counts; balanced when they add up."""
    per_id = (
        tagged.groupBy(F.when(F.col("reason").isNull(), F.col("clean.txn_id")).alias("txn_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    id_known = F.col("txn_id").isNotNull()
    counts = per_id.agg(
        F.sum("n").alias("staged"),
        F.coalesce(F.sum(F.when(id_known, F.col("n"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(~id_known, F.col("n"))), F.lit(0)).alias("rejected"),
        F.count_if(id_known).alias("fact"),
        F.coalesce(F.sum(F.when(id_known, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )
    return counts.withColumn(
        "balanced", F.col("staged") == F.col("fact") + F.col("rejected") + F.col("duplicates")
    )


def null_census(staging: DataFrame) -> DataFrame:
    """Blank or NULL values per column, only columns that have some."""
    counts = staging.agg(*[F.count_if(tx.is_blank(F.col(c))).alias(c) for c in vocab.STAGING_COLUMNS])
    return counts.unpivot([], vocab.STAGING_COLUMNS, "column_name", "nulls").filter("nulls > 0")


def value_census(staging: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null text of a column."""
    return (
        staging.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def date_forms(staging: DataFrame) -> DataFrame:
    return staging.groupBy(dates.date_form(F.col("sale_date")).alias("form")).agg(F.count(F.lit(1)).alias("n_rows"))


def money_forms(staging: DataFrame) -> DataFrame:
    return staging.groupBy(money.money_form(F.col("unit_price")).alias("form")).agg(F.count(F.lit(1)).alias("n_rows"))


def date_pattern_census(staging: DataFrame) -> DataFrame:
    """Non-null dates per anchored pattern, and those matching none."""
    day = F.col("sale_date")
    label = F.lit(vocab.NO_PATTERN)
    for name, pattern in reversed(vocab.DATE_PATTERNS.items()):
        label = F.when(day.rlike(pattern), name).otherwise(label)
    counted = staging.filter(day.isNotNull()).groupBy(label.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    names = staging.sparkSession.createDataFrame(
        [(p,) for p in [*vocab.DATE_PATTERNS, vocab.NO_PATTERN]], "pattern string"
    )
    return names.join(counted, "pattern", "left").select(
        "pattern", F.coalesce("n", F.lit(0).cast("long")).alias("n_rows")
    )


def unmatched_dates(staging: DataFrame) -> DataFrame:
    """Frequency of the non-null date texts no pattern matches."""
    matches = [F.col("sale_date").rlike(p) for p in vocab.DATE_PATTERNS.values()]
    none = ~(matches[0] | matches[1] | matches[2])
    return value_census(staging.filter(none), "sale_date")


def quantity_signs(staging: DataFrame) -> DataFrame:
    """How many quantities read as numbers are negative, how many zero."""
    number = F.col("quantity").try_cast("double")
    return staging.agg(F.count_if(number < 0).alias("negative"), F.count_if(number == 0).alias("zero"))


def distinct_before_after(tagged: DataFrame) -> DataFrame:
    """Distinct categories and statuses as written (NULL as blank) and as loaded."""
    def before(name: str) -> Column:
        return F.count_distinct(F.coalesce(tx.strip(F.col(f"raw.{name}")), F.lit("")))

    def after(name: str) -> Column:
        return F.count_distinct(F.when(F.col("reason").isNull(), F.col(f"clean.{name}")))

    counts = tagged.agg(
        before("category").alias("cb"), after("category").alias("ca"),
        before("status").alias("sb"), after("status").alias("sa"),
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), F.col(b).alias("distinct_raw"), F.col(a).alias("distinct_clean"))
                    for f, b, a in (("category", "cb", "ca"), ("status", "sb", "sa"))
                ]
            )
        )
    )


def reject_census(tagged: DataFrame) -> DataFrame:
    """Rejected rows per reason with their share of all staged rows.

    One row per reason: the window spans the fixed list of reasons.
    """
    counts = tagged.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    staged = F.sum("n_rows").over(Window.partitionBy())
    return (
        counts.withColumn("pct_staged", percent(F.col("n_rows"), staged, 2))
        .filter("reason is not null")
    )


def load_report(tagged: DataFrame) -> DataFrame:
    """The quality figures of a load as (topic, item, n_rows), in one pass over the rows.

    Blank fields per column, date and money forms, reject reasons, and how many
    distinct categories and statuses there are as written and as loaded. Each row
    unfolds to three facts (its forms, its category, its status), which are
    counted before they move and only then told apart; malformed lines have no
    fields and count as a reason only.
    """
    whole = F.col("reason").isNull() | (F.col("reason") != vocab.MALFORMED)
    blank = F.concat(*[F.when(whole & tx.is_blank(F.col(f"raw.{c}")), "1").otherwise("0") for c in vocab.STAGING_COLUMNS])
    no_text = F.lit(None).cast("string")

    def fact(kind: str, *texts: Column) -> Column:
        padded = [*texts, *[no_text] * (4 - len(texts))]
        return F.struct(F.lit(kind).alias("kind"), *[t.alias(f"t{i}") for i, t in enumerate(padded)])

    pairs = ("category", "status")
    facts = [fact(
        "forms", F.col("reason"), F.when(whole, dates.date_form(F.col("raw.sale_date"))),
        F.when(whole, money.money_form(F.col("raw.unit_price"))), blank,
    )]
    for name in pairs:
        as_written = F.when(whole, F.coalesce(tx.strip(F.col(f"raw.{name}")), F.lit("")))
        facts.append(fact(name, as_written, F.when(F.col("reason").isNull(), F.col(f"clean.{name}"))))
    keys = ["kind", "t0", "t1", "t2", "t3"]
    told = tagged.select(F.inline(F.array(*facts))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def item(topic: Column, kind: str, text: Column) -> Column:
        return F.struct(topic.alias("topic"), F.when(F.col("kind") == kind, text).alias("item"))

    items = [item(F.lit(t), "forms", F.col(c)) for t, c in (("reason", "t0"), ("date form", "t1"), ("money form", "t2"))]
    items += [
        item(F.lit("blank"), "forms", F.when(F.substring("t3", i + 1, 1) == "1", c)) for i, c in enumerate(vocab.STAGING_COLUMNS)
    ]
    spreads = {f"{name} as {how}": (name, c) for name in pairs for how, c in (("written", "t0"), ("loaded", "t1"))}
    items += [item(F.lit(topic), name, F.col(c)) for topic, (name, c) in spreads.items()]
    counts = told.select("n", F.inline(F.array(*items))).filter("item is not null").groupBy("topic", "item").agg(F.sum("n").alias("n"))
    spread = F.col("topic").isin(*spreads)
    return counts.groupBy(
        F.when(spread, "distinct").otherwise(F.col("topic")).alias("topic"),
        F.when(spread, F.col("topic")).otherwise(F.col("item")).alias("item"),
    ).agg(F.sum(F.when(spread, 1).otherwise(F.col("n"))).alias("n_rows"))


def rejected_share(tagged: DataFrame) -> DataFrame:
    """Share of staged rows that were rejected, one row."""
    return tagged.agg(
        percent(F.count_if(F.col("reason").isNotNull()), F.count(F.lit(1))).alias("rejected_pct")
    )


def status_domain(fact: DataFrame) -> DataFrame:
    """Rows per status after the load."""
    return fact.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))
