"""Ordered work along one key's history that survives a key holding most of the rows.

Previous row, next row, carried value and running sum are window functions. A window
per key puts a key's whole history into one task, so a key is cut into slices along its
order, the window runs per (key, slice), and what crosses a slice border - one row per
slice - is worked out on the side and joined back.

The cuts are rows of the table itself: those whose hash of key and order falls on one
in so many. So they need no counts, come as densely as the rows do, work for any type
that can be ordered, and are the same whenever and wherever they are looked up again.
They are found inside the plan. Nothing runs while a plan is built, and one plan serves
every size: a small table has no cuts, which adaptive execution sees before it starts
the rest, and then leaves the side work out.

At most ``MOST_CUTS`` cuts are taken, those with the lowest hashes, which is what bounds
the side tables and why they may be broadcast. A slice then holds one row in
``MOST_CUTS`` of the table on average where that is more than ``split_rows`` asks for,
and hardly ever twelve times the average. Only rows that agree in key, time and tie
cannot be cut. Nulls come first in the order, NaN last, as in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebook.operators.sizing import rows_per_cut

SLICE = "_slice"
MOST_CUTS = 400_000
# Cuts that a row is compared with lie in blocks, so that no row carries more than two short lists.
BLOCK = 512
# How many blocks of cuts a row's key has, null for keys without any.
CUT = "_cut"
UP_TO_HERE = " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
EVERYTHING = " ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def beside(df: DataFrame, side: DataFrame, names: list[str], how: str = "left", bounded: bool = True) -> DataFrame:
    """Join a side frame on null-safe equality. Sides whose size is bounded are broadcast."""
    renamed = side.select(*[F.col(c).alias(f"_side_{c}") if c in names else F.col(c) for c in side.columns])
    cond = F.lit(True)
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_side_{c}"))
    return df.join(F.broadcast(renamed) if bounded else renamed, cond, how).drop(*[f"_side_{c}" for c in names])


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def listed(names: list[str], of: str = "") -> str:
    return ", ".join(of + q(n) for n in names)


def same(names: list[str], left: str, right: str) -> str:
    return " AND ".join(f"{left}.{q(n)} <=> {right}.{q(n)}" for n in names)


def passed(array: str, test: str) -> str:
    """How many elements at the head of an array pass a test that no later one passes once one fails, by halving.

    In SQL, as all plans of this module: one text is much faster to put together than as many calls. ``{}`` in the test
    stands for the element.
    """
    return (
        f"IF(size({array}) > 0, aggregate(sequence(CAST(floor(log2(size({array}))) AS INT), 0), 0, (so_far, power) -> "
        f"IF({test.format(f'get({array}, so_far + shiftleft(1, power) - 1)')}, so_far + shiftleft(1, power), so_far)), 0)"
    )


def cuts_sql(key: list[str], order: list[str], rows: int) -> str:
    """At most ``MOST_CUTS`` cuts of ``{like}``: in ``blocks`` by key and number of the block, and each key's ``heads``."""
    k, o = listed(key), listed(order)
    return f"""some AS (SELECT {k}, {o}, CAST((row_number() OVER (PARTITION BY {k} ORDER BY {o}) - 1) div {BLOCK} AS INT) AS _block
      FROM (SELECT DISTINCT {k}, {o}, xxhash64({k}, {o}) AS _hash FROM {{like}} WHERE pmod(xxhash64({k}, {o}), {rows}) = 0
        ORDER BY _hash LIMIT {MOST_CUTS})),
    blocks AS (SELECT {k}, _block, sort_array(collect_list(struct({o}))) AS _cuts FROM some GROUP BY {k}, _block),
    heads AS (SELECT {k}, sort_array(collect_list(struct(_block, get(_cuts, 0) AS at))).at AS _heads, CAST(count(*) AS INT) AS {CUT}
      FROM blocks GROUP BY {k})"""


class Timeline:
    """One frame, its key and its order; each method adds a column and returns a new one."""

    def __init__(self, df: DataFrame, key: list[str], order: list[str]) -> None:
        self.df, self.key, self.order = df, key, order

    @classmethod
    def of(cls, df: DataFrame | Timeline, key: str | list[str], time: str, tie: str | None = None,
           like: DataFrame | None = None) -> Timeline:
        """``like`` is a frame to take the cuts from, when that is cheaper and its rows lie about as those of ``df``.

        A timeline that has this key and order already is used as it is.
        """
        key = [key] if isinstance(key, str) else list(key)
        order = [time] + ([tie] if tie else [])
        if isinstance(df, Timeline):
            if (df.key, df.order) == (key, order):
                return df
            df = df.rows()
        own, at = listed(df.columns, "d."), f"struct({listed(order, 'd.')})"
        text = f"""WITH {cuts_sql(key, order, rows_per_cut(df.sparkSession))},
        d AS (SELECT /*+ BROADCAST(h) */ {own}, {passed("h._heads", "{} <= " + at)} - 1 AS _block, h.{CUT}
          FROM {{df}} d LEFT JOIN heads h ON {same(key, "d", "h")})
        SELECT /*+ BROADCAST(c) */ {own}, CAST(CASE WHEN d.{CUT} IS NULL THEN -1 WHEN c._cuts IS NULL THEN 0
            ELSE d._block * {BLOCK} + {passed("c._cuts", "{} <= " + at)} END AS BIGINT) AS {SLICE}, d.{CUT}
        FROM d LEFT JOIN blocks c ON {same(key, "d", "c")} AND d._block = c._block"""
        return cls(df.sparkSession.sql(text, df=df, like=df if like is None else like), key, order)

    # -- windows ---------------------------------------------------------------

    @property
    def parts(self) -> list[str]:
        """Columns that bound one window group."""
        return [*self.key, SLICE]

    def window(self):
        # A condition on the cuts goes down through the window, as one on the key would.
        return Window.partitionBy(*self.parts, CUT).orderBy(*self.order)

    def with_rows(self, df: DataFrame) -> Timeline:
        """The same timeline with other rows or columns, which still hold key, order and slice."""
        return Timeline(df, self.key, self.order)

    def heavy(self) -> DataFrame:
        """The rows of keys that are cut; when there are no cuts that is known before any row is read."""
        return self.df.filter(F.col(CUT).isNotNull())

    def _added(self, inside: dict[str, tuple], at_border: dict[str, str], across: dict[str, tuple], both: dict[str, str]) -> Timeline:
        """Columns ``both``, in SQL, of ``inside`` a slice and of what comes ``across`` its border.

        ``inside`` are window functions of the rows; ``at_border`` are aggregates of a slice of a heavy key, one row
        each, and ``across`` window functions of these.
        """
        kept = listed([c for c in self.df.columns if c not in both], "d.")
        group = listed(self.parts)
        text = f"""SELECT /*+ BROADCAST(b) */ {kept}, {", ".join(f"{v} AS {q(n)}" for n, v in both.items())}
        FROM (SELECT *, {", ".join(f"{v} OVER (PARTITION BY {group}, {CUT} ORDER BY {listed(self.order)}{w}) AS {n}"
                         for n, (v, w) in inside.items())} FROM {{df}}) d
        LEFT JOIN (SELECT {group}, {", ".join(f"{v} OVER (PARTITION BY {listed(self.key)} ORDER BY {SLICE}{w}) AS {n}"
                                             for n, (v, w) in across.items())}
          FROM (SELECT {group}, {", ".join(f"{v} AS {n}" for n, v in at_border.items())} FROM {{df}}
            WHERE {CUT} IS NOT NULL GROUP BY {group})) b ON {same(self.parts, "d", "b")}"""
        return self.with_rows(self.df.sparkSession.sql(text, df=self.df))

    def _row(self, columns: tuple[str, ...]) -> str:
        return f"struct({listed(list(columns))})"

    def _place(self) -> str:
        return f"struct({listed(self.order)})"

    # -- added columns ---------------------------------------------------------

    def previous(self, name: str, *columns: str) -> Timeline:
        """``name``: struct of the columns of the key's previous row, null on the first."""
        row = self._row(columns)
        return self._added(
            {"_own": (f"lag({row})", "")}, {"_edge": f"max_by({row}, {self._place()})"}, {"_edge": ("lag(_edge)", "")},
            {name: "coalesce(d._own, b._edge)"},
        )

    def following(self, name: str, *columns: str) -> Timeline:
        """``name``: struct of the columns of the key's next row, null on the last."""
        row = self._row(columns)
        return self._added(
            {"_own": (f"lead({row})", "")}, {"_edge": f"min_by({row}, {self._place()})"}, {"_edge": ("lead(_edge)", "")},
            {name: "coalesce(d._own, b._edge)"},
        )

    def last(self, name: str, *columns: str) -> Timeline:
        """``name``: struct of the columns of the key's last row."""
        row = self._row(columns)
        return self._added(
            {"_own": (f"last({row})", EVERYTHING)}, {"_edge": f"max_by({row}, {self._place()})"},
            {"_edge": ("last(_edge)", EVERYTHING)}, {name: "coalesce(b._edge, d._own)"},
        )

    def _valued(self, values: dict[str, Column]) -> tuple[Timeline, dict[str, str]]:
        """The values as columns of their own, by the names they are to have."""
        names = {n: f"_of_{n}" for n in values}
        return self.with_rows(self.df.select("*", *[v.alias(names[n]) for n, v in values.items()])), names

    def carry(self, **values: Column) -> Timeline:
        """Each value's last non-null up to and including the row."""
        line, names = self._valued(values)
        at = {n: f"max_by({q(c)}, IF({q(c)} IS NOT NULL, {self._place()}, NULL))" for n, c in names.items()}
        out = line._added(
            {q(f"_own_{n}"): (f"last({q(c)}, true)", UP_TO_HERE) for n, c in names.items()}, {q(f"_in_{n}"): v for n, v in at.items()},
            {q(f"_in_{n}"): (f"last({q(f'_in_{n}')}, true)", BEFORE) for n in names},
            {n: f"coalesce(d.{q(f'_own_{n}')}, b.{q(f'_in_{n}')})" for n in names},
        )
        return out.with_rows(out.df.drop(*names.values()))

    def running(self, **values: Column) -> Timeline:
        """Each value's running sum up to and including the row."""
        line, names = self._valued(values)
        out = line._added(
            {q(f"_own_{n}"): (f"sum({q(c)})", UP_TO_HERE) for n, c in names.items()}, {q(f"_in_{n}"): f"sum({q(c)})" for n, c in names.items()},
            {q(f"_in_{n}"): (f"sum({q(f'_in_{n}')})", BEFORE) for n in names},
            {n: f"coalesce(d.{q(f'_own_{n}')}, 0) + coalesce(b.{q(f'_in_{n}')}, 0)" for n in names},
        )
        return out.with_rows(out.df.drop(*names.values()))

    def filter(self, condition: Column) -> Timeline:
        return self.with_rows(self.df.filter(condition))

    def select(self, *columns: Column | str) -> Timeline:
        """Other columns; key and order must be among them."""
        return self.with_rows(self.df.select(*columns, SLICE, CUT))

    def rows(self) -> DataFrame:
        return self.df.drop(SLICE, CUT)
