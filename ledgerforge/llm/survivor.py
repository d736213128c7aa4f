"""Best representative of each duplicate group (problem 1).

``line_groups`` finds the rows that read one line of one purchase order; ``survive``
is the general operator: fields are unpivoted to long rows, every normalised
value gathers the votes of its rows (source trust times recency decay), the
winner of each field is taken by max_by, and the winners are pivoted back.

All steps are equi-joins and aggregations with partial aggregation before the
shuffle; no group is ever gathered in one place, so a group may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.session import cut

#: Spellings of the confidence of a reading, and its trust.
CONFIDENCE = {"high": ("high", "tinggi"), "medium": ("medium", "sedang"), "low": ("low", "rendah")}
TRUST = {"high": 1.0, "medium": 0.6, "low": 0.3}
#: The own columns of po_customer.
OWN = ("purchase_order_no", "vendor_code", "po_issuer", "ppn", "product_code", "product_name", "qty", "uon", "unit_price", "discount", "total")


def confidence_level(c: Column) -> Column:
    """high, medium, low or null of a typed confidence."""
    word = F.lower(F.trim(c))
    out = F.lit(None).cast("string")
    for level, words in CONFIDENCE.items():
        out = F.when(word.isin(*words), level).otherwise(out)
    return out


def order_number(c: Column) -> Column:
    """An order number without label, blanks, marks and decimal places, letters read for digits folded; null if nothing is left."""
    s = F.regexp_replace(F.upper(F.trim(c)), r"\.0$", "")
    s = F.regexp_replace(F.regexp_replace(s, r"^.*:", ""), r"[^A-Z0-9]", "")
    s = F.regexp_replace(s, r"^PO(?=.{6})", "")
    return F.nullif(F.translate(s, "OILSBZGQ", "01158269"), F.lit(""))


def vendor_code(c: Column) -> Column:
    """The digits of a code, without label and blanks; null for placeholders, names and zeros."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), r"^.*:", ""), r"\.0$", ""), r"\s", "")
    return F.when(s.rlike(r"^\d+$") & ~s.rlike(r"^0+$"), s)


def product_words(c: Column) -> Column:
    """A product name in upper case without marks, digits read for letters inside words put right, GR for G."""
    s = F.regexp_replace(F.upper(c), r"[^A-Z0-9]+", " ")
    for digit, letter in (("4", "A"), ("0", "O"), ("1", "I"), ("5", "S"), ("8", "B"), ("6", "G")):
        s = F.regexp_replace(s, rf"(?<=[A-Z]){digit}|{digit}(?=[A-Z]{{2}})", letter)
    return F.trim(F.regexp_replace(s, r"(?<=\d )G$", "GR"))


def _tops(df: DataFrame, by: str, values: dict[str, str]) -> DataFrame:
    """The most frequent non-null value of several columns for each key: counted by value, then one aggregation a key; ties go by the value's hash."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("k"), F.col(c).alias("v")) for n, c in values.items()])).alias("x")
    n = df.where(F.col(by).isNotNull()).select(by, each).where("x.v is not null").groupBy(by, F.col("x.k").alias("k"), F.col("x.v").alias("v")).agg(F.count("*").alias("n"))
    return n.groupBy(by).agg(*[F.expr(f"max_by(v, struct(n, xxhash64(v), v)) FILTER (WHERE k = '{name}')").alias(name) for name in values])


def line_groups(po: DataFrame, carry: dict[str, Column]) -> DataFrame:
    """id, the columns of ``carry`` made of ``po``, and ``group_key``: equal for rows that read the same line of the same order of the same issuer.

    The issuer is the one of the document (the code in its folder, else its most
    typed vendor code); the order number is the most typed one of the document,
    unless a row's own differs by more than misreading; the product is its code,
    else the code that its name mostly carries, else the nearest name of the
    order within three edits; a missing qty is filled from the line of the order
    and product that its price and total prove, or that is the only one.

    Defined results: rows without document stand on their own order number, and
    without that alone; rows with nothing to go by get a key of their own;
    repeated rows share a key. Other columns are dropped, whatever their names: only what is carried is shuffled.

    The state is written to the shared folder twice, as every later step looks at the whole of the one before.
    """
    t = po.select(
        "id", *[c.alias(n) for n, c in carry.items()], "qty", "total", "unit_price", "discount", order_number(F.col("purchase_order_no")).alias("_po"), vendor_code(F.col("vendor_code")).alias("_vc"),
        F.nullif(F.regexp_extract("folder", r"/(\d{6,}) - ", 1), F.lit("")).alias("_fc"), F.col("document_id").alias("_doc"),
        product_words(F.col("product_name")).alias("_words"), F.when(F.trim("product_code").rlike(r"^\d{4,}$"), F.trim("product_code")).alias("_code"),
    )
    t = t.withColumn("_doc", F.coalesce("_doc", F.concat(F.lit("?"), F.coalesce("_po", F.col("id").cast("string")))))
    t = t.join(_tops(t, "_doc", {"_major": "_po", "_folder": "_fc", "_vendor": "_vc"}), "_doc", "left")
    own = F.col("_po").rlike(r"^\w{6,}$") & (F.levenshtein("_po", "_major") > 3)
    number = F.coalesce(F.when(own, F.col("_po")).otherwise(F.col("_major")), F.concat(F.lit("#"), "_doc"))
    t = cut(t.select("id", *carry, "qty", "total", "unit_price", "discount", "_words", "_code", F.concat_ws("/", F.coalesce("_folder", "_vendor", F.lit("?")), number).alias("_order")))
    t = t.join(_tops(t, "_words", {"_named": "_code"}), "_words", "left").withColumn("_product", F.coalesce("_code", "_named")).drop("_code", "_named")
    t = cut(t)
    # names that nobody gave a code: the nearest of the same order
    lost = t.where("_product is null").select("_order", "_words").distinct()
    known = t.where("_product is not null").select("_order", F.col("_words").alias("_kw"), F.col("_product").alias("_kp")).distinct()
    near = lost.join(known, "_order").withColumn("_d", F.levenshtein("_words", "_kw", 3)).where("_d >= 0").groupBy("_order", "_words").agg(F.min_by("_kp", F.struct("_d", "_kp")).alias("_near"))
    t = t.join(near, ["_order", "_words"], "left").withColumn("_product", F.coalesce("_product", "_near", F.concat(F.lit("~"), "_words"), F.lit(""))).drop("_near", "_words")
    # a missing qty: few rows against the lines of their order and product
    empty = t.where("qty is null").select("id", "_order", "_product", F.col("total").alias("_t"), F.round((F.col("total") + F.coalesce("discount", F.lit(0))) / F.nullif("unit_price", F.lit(0)), 2).alias("_implied"), F.col("unit_price").alias("_u"), F.col("discount").alias("_c"))
    lines = t.where("qty is not null").select("_order", "_product", "qty", F.col("total").alias("_lt"), F.col("unit_price").alias("_lu"), F.col("discount").alias("_lc")).distinct()
    score = F.when(F.col("_implied") == F.col("qty"), 8).otherwise(0) + F.when(F.col("_t") == F.col("_lt"), 4).otherwise(0) + F.when(F.col("_u") == F.col("_lu"), 1).otherwise(0) + F.when((F.col("_c") == F.col("_lc")) & (F.col("_c") > 0), 2).otherwise(0)
    fit = empty.join(lines, ["_order", "_product"]).groupBy("id", "qty").agg(F.max(score).alias("_s")).groupBy("id").agg(F.max_by("qty", F.struct("_s", "qty")).alias("_qty"), F.max("_s").alias("_s"), F.count("*").alias("_n")).where("_n = 1 or _s > 1").select("id", "_qty")
    t = t.join(fit, "id", "left")
    # rows whose qty stays unknown meet each other only on the same total
    qty = F.coalesce(F.coalesce("qty", "_qty").cast("string"), F.concat(F.lit("?"), F.coalesce(F.col("total").cast("string"), F.col("id").cast("string"))))
    return t.select("id", *carry, F.concat_ws("|", "_order", "_product", qty).alias("group_key"))


def survive(
    rows: DataFrame,
    group: str,
    fields: dict[str, Column],
    weight: Column | None = None,
    precedence: Column | None = None,
    keep: tuple[str, ...] = (),
    least: int = 1,
) -> DataFrame:
    """One row a group with the winner of every field, and ``first_id``, the least id that voted.

    rows: needs columns ``group`` and ``id``; fields: name -> normalised value (null: no vote).
    weight: votes of a row, a double or a whole number that may be as large as decimal(20,0), summed by value; without
    it every row has one vote. precedence: orders rows; between equal votes the value whose best row comes first wins,
    and a field's ``<name>_id`` is that row's id. Without it the smallest id comes first.
    keep: names of ``fields`` whose value isn't wanted, only its id. least: groups with fewer rows that vote for their
    most voted field are left out.

    Votes are added by group, field and value, so a group of any size is spread over its values and summed before it is
    shuffled; the winners of all fields of a group are one aggregation more.
    """
    first = precedence if precedence is not None else -F.col("id")
    w = weight if weight is not None else F.lit(1)
    long = rows.select(
        F.col(group).alias("_g"), F.col("id").alias("_id"), w.alias("_w"), first.alias("_first"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.cast("string").alias("value")) for n, v in fields.items()])).alias("_v"),
    ).where("_v.value is not null")
    # rounded so that the order in which votes are added doesn't decide
    votes = long.groupBy("_g", F.col("_v.field").alias("_f"), F.col("_v.value").alias("_value")).agg(F.round(F.sum("_w"), 9).alias("_votes"), F.max(F.struct("_first", "_id")).alias("_best"), F.count("*").alias("_n"), F.min("_id").alias("_least"))
    won = lambda n: F.expr(f"max_by(struct(_value, _best), struct(_votes, _best._first, _value)) FILTER (WHERE _f = '{n}')").alias(f"_{n}")
    size = F.greatest(*[F.coalesce(F.expr(f"sum(_n) FILTER (WHERE _f = '{n}')"), F.lit(0)) for n in fields], F.lit(0)).alias("_size")
    g = votes.groupBy(F.col("_g").alias(group)).agg(*[won(n) for n in fields], size, F.min("_least").alias("first_id")).where(F.col("_size") >= least)
    return g.select(group, *[F.col(f"_{n}._value").alias(n) for n in fields if n not in keep], *[F.col(f"_{n}._best._id").alias(f"{n}_id") for n in fields], "first_id")


def reading_order() -> Column:
    """Which row of po_customer comes first: by confidence, fewest nulls in the own columns, latest update, smallest id."""
    level = confidence_level(F.col("confidence"))
    rank = F.when(level == "high", 3).when(level == "medium", 2).when(level == "low", 1).otherwise(0)
    nulls = sum((F.col(c).isNull().cast("int") for c in OWN), F.lit(0))
    return F.struct(rank.alias("a"), (-nulls).alias("b"), F.coalesce(F.col("updated_at").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("c"), (-F.col("id")).alias("d"))


#: What a step of trust is worth: more than all microseconds of the years 1 to 2200.
STEP = 70_000_000_000_000_000


def reading_votes() -> Column:
    """The votes of a row of po_customer: a step of trust for each level of confidence and each filled own column, less what age takes, under one step.

    Confidence weighs more than all columns together, a column more than any age; a row without time is as old as can be.
    """
    level = confidence_level(F.col("confidence"))
    rank = F.when(level == "high", 3).when(level == "medium", 2).when(level == "low", 1).otherwise(0)
    filled = sum((F.col(c).isNotNull().cast("int") for c in OWN), F.lit(0))
    trust = (rank * (len(OWN) + 1) + filled).cast("decimal(4,0)") * F.lit(STEP).cast("decimal(18,0)")
    young = F.coalesce(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'0001-01-01 00:00:00', cast(updated_at AS timestamp_ntz))"), F.lit(0))
    return (trust + F.least(F.greatest(young, F.lit(0)), F.lit(STEP - 1)).cast("decimal(18,0)")).cast("decimal(20,0)")


def reading_trust() -> Column:
    """The trust of a reading of po_customer."""
    level = confidence_level(F.col("confidence"))
    return F.when(level == "high", TRUST["high"]).when(level == "medium", TRUST["medium"]).when(level == "low", TRUST["low"]).otherwise(0.1)


def decayed(trust: Column, updated: Column, latest: Column, half_life_days: float = 30.0) -> Column:
    """Trust halved with every half-life that a row is older than the latest of its group; a row without time keeps a hundredth."""
    age = F.greatest(F.lit(0.0), F.datediff(latest, updated).cast("double"))
    return trust * F.coalesce(F.pow(F.lit(0.5), age / half_life_days), F.lit(0.01))


def grouped(po: DataFrame, carry: dict[str, Column]) -> DataFrame:
    """``line_groups`` of two or more rows, with _first_id and, if ``updated`` is carried, _latest."""
    rows = cut(line_groups(po, carry))
    latest = [F.max("updated").alias("_latest")] if "updated" in carry else []
    sizes = rows.groupBy("group_key").agg(F.count("*").alias("_n"), F.min("id").alias("_first_id"), *latest).where("_n > 1").drop("_n")
    return rows.join(sizes, "group_key")
