"""DuckDB SQL of the outlet-segmentation queries.

The rules are tables joined to the data: a revenue ladder with bounds, and the
named moves between two tiers.  Inputs are derived from the raw driver tables
(``lineitem``, ``supplier``, ... are registered as views by the checker); run
months are written out here, nothing is taken from the package.
"""

from __future__ import annotations

# Run month, the month before it, and the seed months of either run: the
# quarter before the run's quarter.
RUN, PREVIOUS = "2000-04", "2000-03"
_THIRD, _FOURTH = ("1999-07", "1999-08", "1999-09"), ("1999-10", "1999-11", "1999-12")
SEED = {"1999-11": _THIRD, "1999-12": _THIRD, "2000-01": _FOURTH, "2000-02": _FOURTH, PREVIOUS: _FOURTH,
        RUN: ("2000-01", "2000-02", "2000-03")}

# Ladder bounds, tier names, ages and move labels.
RULES = """
ladder(least, below, tier, group_tier) AS (VALUES
  (0, 10000000, 'Bronze', 'Regular'),
  (10000000, 25000000, 'Silver', 'Regular'),
  (25000000, 50000000, 'Gold', 'G/P'),
  (50000000, 150000000, 'Platinum', 'G/P'),
  (150000000, NULL, 'Diamond', 'G/P')),
moves(was, became, label) AS (VALUES
  ('G/P', 'G/P', 'Active G/P'),
  ('G/P', 'Regular', 'Downgrade to Regular'),
  ('G/P', 'No Trx', 'No Trx G/P'),
  ('NEW', 'G/P', 'New G/P'),
  ('Regular', 'G/P', 'Upgrade to G/P'),
  ('No Trx', 'G/P', 'Back Active to G/P'),
  ('Regular', 'Regular', 'Active Regular'),
  ('Regular', 'No Trx', 'No Trx Regular'),
  ('NEW', 'Regular', 'New Regular'),
  ('No Trx', 'Regular', 'Back Active to Regular'),
  ('No Trx', 'No Trx', 'Churn'))"""

INPUTS = """
sales AS (
  SELECT pos_code, month_year, (month_year || '-01')::DATE AS month_year_date, revenue FROM (
    SELECT l_suppkey || '-' || (l_partkey % (l_suppkey % 16 + 1)) AS pos_code, strftime(l_shipdate, '%Y-%m') AS month_year,
           (sum(l_extendedprice::DECIMAL(18, 2)) * 900)::BIGINT AS revenue
    FROM lineitem GROUP BY ALL)),
outlet AS (
  SELECT s_suppkey || '-' || slot AS pos_code, ((s_suppkey + slot) % 24)::INTEGER AS age, s_acctbal AS bal
  FROM (SELECT s_suppkey, s_acctbal, unnest(range(0, s_suppkey % 16 + 1)) AS slot FROM supplier) WHERE s_acctbal >= 0),
aging AS (
  SELECT pos_code, age AS pos_aging FROM outlet UNION ALL SELECT pos_code, age + 1 FROM outlet WHERE bal > 9500)"""

_BASE = "month_year, month_year_date, pos_code, revenue, pos_aging, pos_tiering, real_pos_tiering, revenue_tiering"
_ADDED = ("previous_tiering", "previous_real_tiering", "previous_revenue", "tiering_changes", "is_diamond", "new_tiering")
_OUT = ", ".join((_BASE, *_ADDED))
# Month order of an outlet; the rest makes it total where ages are booked twice.
_TOTAL = ("month_year_date", "pos_aging", "pos_tiering", "real_pos_tiering", "revenue")


def _by(direction: str) -> str:
    return ", ".join(f"{c} {direction}" for c in _TOTAL)


def _quarter(date: str) -> str:
    return f"year({date}) || '-' || quarter({date})"


def _tiered(source: str) -> str:
    return f"""SELECT s.month_year, s.month_year_date, s.pos_code, s.revenue, a.pos_aging,
    if(coalesce(a.pos_aging < 3, false), 'NEW', coalesce(l.group_tier, 'Undefined')) AS pos_tiering,
    coalesce(l.group_tier, 'Undefined') AS real_pos_tiering, coalesce(l.tier, 'Undefined') AS revenue_tiering
  FROM {source} s LEFT JOIN aging a USING (pos_code)
  LEFT JOIN ladder l ON s.revenue > 0 AND s.revenue >= l.least AND (l.below IS NULL OR s.revenue < l.below)"""


def _run(tag: str, month: str, before: str, history: str) -> str:
    """The tables of one monthly run, named with ``tag``."""
    seed = ", ".join(f"'{m}'" for m in SEED[month])
    return f"""
{tag}_feed AS (SELECT * FROM sales WHERE month_year = '{month}'),
{tag}_stage AS ({_tiered(f"{tag}_feed")} UNION ALL SELECT {_BASE} FROM {history} WHERE month_year = '{before}'),
{tag}_newest AS (SELECT * FROM {tag}_stage QUALIFY row_number() OVER (PARTITION BY pos_code ORDER BY {_by("DESC NULLS LAST")}) = 1),
{tag}_gone AS (
  SELECT '{month}' AS month_year, DATE '{month}-01' AS month_year_date, n.pos_code, 0::BIGINT AS revenue, a.pos_aging,
    'No Trx' AS pos_tiering, 'Undefined' AS real_pos_tiering, 'Undefined' AS revenue_tiering
  FROM {tag}_newest n LEFT JOIN aging a USING (pos_code) WHERE n.month_year <> '{month}'),
{tag}_lagged AS (
  SELECT *, lag(pos_tiering) OVER o AS previous_tiering, lag(real_pos_tiering) OVER o AS previous_real_tiering,
    lag(revenue) OVER o AS previous_revenue
  FROM (FROM {tag}_stage UNION ALL FROM {tag}_gone) WINDOW o AS (PARTITION BY pos_code ORDER BY {_by("ASC NULLS FIRST")})),
{tag}_moved AS (SELECT g.*, m.label AS tiering_changes FROM {tag}_lagged g LEFT JOIN moves m
  ON m.was = g.previous_tiering AND m.became = g.pos_tiering),
{tag}_final AS (SELECT * FROM {tag}_moved WHERE month_year = '{month}'),
{tag}_peaks AS (SELECT DISTINCT pos_code, month_year, month_year_date FROM {history}
  WHERE revenue_tiering = 'Diamond' AND month_year IN ({seed})),
{tag}_flag AS (
  SELECT pos_code, {_quarter("month_year_date")} AS quarter_real, {_quarter("(month_year_date + INTERVAL 3 MONTH)")} AS quarter_next,
    count(*) AS total_diamond, if(count(*) > 2, 'Diamond', 'Not Diamond') AS is_diamond
  FROM {tag}_peaks GROUP BY ALL),
{tag}_out AS (SELECT f.*, d.is_diamond, {_NEW_TIER.format(t="f")} AS new_tiering
  FROM {tag}_final f LEFT JOIN {tag}_flag d ON d.pos_code = f.pos_code AND d.quarter_next = {_quarter("f.month_year_date")})"""


_NEW_TIER = "if(d.is_diamond = 'Diamond', 'Diamond', if({t}.revenue_tiering = 'Diamond', 'Platinum', {t}.revenue_tiering))"
_NOTHING = "NULL::VARCHAR AS previous_tiering, NULL::VARCHAR AS previous_real_tiering, NULL::BIGINT AS previous_revenue, " \
           "NULL::VARCHAR AS tiering_changes, NULL::VARCHAR AS is_diamond, NULL::VARCHAR AS new_tiering"


def _plain(select: str) -> str:
    return f"WITH {RULES.strip()},{INPUTS}\n{select}"


def _p1(select: str) -> str:
    """``select`` over the two runs; months before them hold plain tiers."""
    return _plain("").rstrip() + f""",
early AS (SELECT * FROM sales WHERE month_year < '{PREVIOUS}'),
past AS ({_tiered("early")}),
{_run("one", PREVIOUS, "2000-02", "past").strip()},
history AS (SELECT {_BASE} FROM past UNION ALL SELECT {_BASE} FROM one_out),
history_full AS (SELECT {_BASE}, {_NOTHING} FROM past UNION ALL SELECT {_OUT} FROM one_out),
{_run("two", RUN, PREVIOUS, "history").strip()}
{select}"""


def _in_turn(months: tuple[str, ...], select: str) -> str:
    """Several run months one after another, each on the table that the one before it left."""
    body = _plain("").rstrip() + f""",
early AS (SELECT * FROM sales WHERE month_year < '{months[0]}'),
table0 AS (SELECT {_BASE} FROM ({_tiered("early")}) t)"""
    for k, month in enumerate(months):
        before = "{}-{:02d}".format(*((int(month[:4]), int(month[5:]) - 1) if month[5:] > "01" else (int(month[:4]) - 1, 12)))
        body += f""",
{_run(f"m{k}", month, before, f"table{k}").strip()},
table{k + 1} AS (SELECT {_BASE} FROM table{k} UNION ALL SELECT {_BASE} FROM m{k}_out)"""
    return body + "\n" + select


def _each(months: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT {_OUT} FROM m{k}_out" for k in range(len(months)))


def segmentation_sql() -> dict[str, str]:
    seed = ", ".join(f"'{m}'" for m in SEED[RUN])
    tiers = "SELECT pos_code, month_year, revenue, {column} FROM (" + _tiered("(SELECT * FROM sales)") + ") t"
    once = " GROUP BY ALL"        # two age records don't repeat a tier
    promoted = _NEW_TIER.format(t="h")
    backfilled, published = tuple(SEED), (PREVIOUS, RUN)
    one_record = "aging AS (SELECT pos_code, age AS pos_aging FROM outlet)"
    return {
        "pos_segmentation_backfill": _in_turn(backfilled, _each(backfilled)),
        "month_write_audit_publish": _in_turn(published, f"SELECT {_BASE}, {_NOTHING} FROM table0 UNION ALL {_each(published)}")
        .replace(INPUTS[INPUTS.index("aging AS"):], one_record),
        "revenue_tiering": _plain(tiers.format(column="revenue_tiering") + once),
        "real_pos_tiering": _plain(tiers.format(column="real_pos_tiering") + once),
        "pos_tiering": _plain(_tiered("sales")),
        "previous_month_slice": _p1(f"SELECT * FROM history WHERE month_year = '{PREVIOUS}'"),
        "pos_union_stage": _p1("FROM two_stage"),
        "latest_per_pos": _p1("SELECT pos_code, month_year, revenue, pos_tiering FROM two_newest"),
        "no_trx_pos": _p1("FROM two_gone"),
        "pos_lag": _p1("FROM two_lagged"),
        "tiering_transition": _p1("SELECT pos_code, month_year, previous_tiering, pos_tiering, tiering_changes FROM two_moved"),
        "seed_month_filter": _p1(f"SELECT * FROM history WHERE month_year IN ({seed})"),
        "diamond_check": _p1("FROM two_flag"),
        "diamond_promotion": _p1(f"SELECT h.pos_code, h.month_year, h.revenue_tiering, d.is_diamond, {promoted} AS new_tiering "
                                 f"FROM history h LEFT JOIN two_flag d ON d.pos_code = h.pos_code AND d.quarter_next = {_quarter('h.month_year_date')}"),
        "pos_final": _p1("FROM two_final"),
        "pos_segmentation_month": _p1("FROM two_out"),
        "duplicate_check": _p1("SELECT pos_code || month_year AS unique_field FROM two_final GROUP BY 1 HAVING count(*) > 1"),
        "month_partition_replace": _p1(f"SELECT * FROM history_full WHERE month_year <> '1995-01' UNION ALL SELECT {_OUT} FROM two_out"),
    }
