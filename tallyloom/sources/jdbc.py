"""Source tables in a relational database, read by many tasks at once.

A load reads the periods it needs, cut into ranges of its time stamps that hold about equal numbers of rows: the database says
in one query where to cut. A whole table is cut by a hash of its key, of whatever type that is. The query texts are those of PostgreSQL.

The queries of one read see the source at different moments. Where rows carry the time of their last change, a load therefore
reads in passes (``Database.read_passes``): what had not changed before a mark, then what has changed since.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.conform import MEASURED_TYPES, SourceColumn, catalogue_columns
from tallyloom.operators.extract import split_table_name

#: Passes that are shared out among many queries; what is left after them is read by one, however much it is.
MOST_PASSES = 4


def jdbc_options(url: str, table: str, fetch_size: int = 10_000, **properties: str) -> dict[str, str]:
    """Options of ``spark.read.format("jdbc")``.

    Time stamps without time zone stay wall-clock time; by default Spark would take them for instants in the
    zone of its virtual machine.
    """
    return {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **properties}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _at(moment: datetime) -> str:
    return f"TIMESTAMP '{moment.isoformat(sep=' ')}'"


def _within(name: str, spans: Sequence[tuple[datetime, datetime]]) -> str:
    return " OR ".join(f"({name} >= {_at(a)} AND {name} < {_at(b)})" for a, b in spans)


def _moments(spans: Sequence[tuple[date, date]]) -> list[tuple[datetime, datetime]]:
    return sorted((datetime.combine(a, time()), datetime.combine(b, time())) for a, b in spans if a < b)


def asked_for(fields: Sequence[str], spans: Sequence[tuple[date, date]]) -> str:
    """Condition that a field lies in one of the spans."""
    return " OR ".join(f"({_within(quoted(f), _moments(spans))})" for f in fields)


def cuts_query(table: str, fields: Sequence[str], spans: Sequence[tuple[date, date]], parts: int, also: str | None = None) -> str:
    """Query for the first moment of every one of ``parts`` equal shares of the rows asked for (and that meet ``also``).

    A row counts under the first of its fields that lies in a span. The database orders the moments and returns one short
    row per share and field: the field's number and where the share begins.
    """
    moments = _moments(spans)
    hits = [(n, quoted(f), _within(quoted(f), moments)) for n, f in enumerate(fields)]
    which = "CASE " + " ".join(f"WHEN {hit} THEN {n}" for n, _, hit in hits) + " END"
    moment = "CASE " + " ".join(f"WHEN {hit} THEN CAST({f} AS timestamp)" for _, f, hit in hits) + " END"
    asked = asked_for(fields, spans)
    if also:
        asked = f"({asked}) AND ({also})"
    dated = f"SELECT {which} AS field, {moment} AS moment FROM {table} WHERE {asked}"
    shares = f"SELECT field, moment, NTILE({parts}) OVER (ORDER BY field, moment) AS share FROM ({dated}) AS dated"
    return f"(SELECT field, MIN(moment) AS start FROM ({shares}) AS shares GROUP BY field, share) AS cuts"


def span_predicates(
    fields: Sequence[str],
    spans: Sequence[tuple[date, date]],
    parts: int,
    cuts: Sequence[tuple[int, datetime]] | None = None,
) -> list[str]:
    """Conditions that share out the rows of which a field lies in one of the spans (half-open).

    Each row meets exactly one: that of the first of its fields which lies in a span. A field that is NULL lies in none.
    ``cuts`` are the places found by ``cuts_query``; without them the spans are cut into equal times. Rows that come in
    after the places were found still meet one condition, as the conditions cover the spans whatever the cuts are.
    """
    if not fields or parts < 1:
        raise ValueError("needs a field and at least one part")
    moments = _moments(spans)
    if not moments:
        return []
    if cuts is None:
        whole = sum((b - a for a, b in moments), timedelta())
        step = max(timedelta(seconds=1), whole / parts)
        even = []
        for first, end in moments:
            while first < end:
                even.append(first)
                first += step
        cuts = [(n, at) for n in range(len(fields)) for at in even]

    out = []
    for n, wanted in enumerate(fields):
        # NULL of an earlier field is no reason to leave a row out.
        earlier = "".join(f" AND NOT COALESCE({_within(quoted(f), moments)}, FALSE)" for f in fields[:n])
        first, end = moments[0][0], max(b for _, b in moments)
        places = [first, *sorted({at for m, at in cuts if m == n and first < at < end}), end]
        for start, stop in zip(places, places[1:]):
            held = [(max(a, start), min(b, stop)) for a, b in moments if a < stop and b > start]
            if held:
                hit = _within(quoted(wanted), held)
                out.append((f"({hit})" if len(held) > 1 else hit) + earlier)
    return out


def changed_between(changed: str, since: datetime | None, upto: datetime | None) -> str:
    """Condition on the time of the last change, from ``since`` on and before ``upto``; no time counts as long ago."""
    name = quoted(changed)
    bounds = []
    if since is not None:
        bounds.append(f"{name} >= {_at(since)}")
    if upto is not None:
        early = f"{name} < {_at(upto)}"
        bounds.append(early if since is not None else f"COALESCE({early}, TRUE)")
    return " AND ".join(bounds)


def clock_query(clock: str) -> str:
    """Query for the time of the database's own clock."""
    return f"(SELECT CAST({clock} AS timestamp) AS moment) AS clock"


def count_query(table: str, condition: str) -> str:
    return f"(SELECT COUNT(*) AS n FROM {table} WHERE {condition}) AS counted"


def key_predicates(key: str, parts: int) -> list[str]:
    """Conditions that share out all rows by a hash of the key, NULL keys in the first part."""
    if parts < 1:
        raise ValueError("needs at least one part")
    place = f"MOD(ABS(HASHTEXT(CAST({quoted(key)} AS text))::bigint), {parts})"
    return [f"{place} = {n}" + (f" OR {quoted(key)} IS NULL" if n == 0 else "") for n in range(parts)]


def length_query(table: str, columns: Sequence[SourceColumn]) -> str | None:
    """Query for the longest text of every measured column, in one row; None if there is no such column."""
    sizes = [
        f"MAX(LENGTH(CAST({quoted(c.name)} AS varchar))) AS {quoted(c.name)}"
        for c in columns
        if c.data_type.lower() in MEASURED_TYPES
    ]
    return f"(SELECT {', '.join(sizes)} FROM {table}) AS lengths" if sizes else None


@dataclass(frozen=True)
class Database:
    """A database that load specs are read from, by ``parts`` queries at once.

    ``clock`` is the database's expression for the present, of the same time zone as the times of change that it stores.
    ``settle`` is longer than any transaction that changes the tables takes from setting those times to its commit.
    Up to ``one_statement`` changed rows are left to the last pass, which is one query.
    """

    spark: SparkSession
    url: str
    parts: int
    properties: dict[str, str] = field(default_factory=dict)
    clock: str = "LOCALTIMESTAMP"
    settle: timedelta = timedelta(minutes=10)
    one_statement: int = 1_000_000

    def _load(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**jdbc_options(self.url, table, **self.properties)).load()

    def _load_parts(self, table: str, predicates: list[str]) -> DataFrame:
        options = jdbc_options(self.url, table, **self.properties)
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return self.spark.read.jdbc(self.url, table, predicates=predicates, properties=rest)

    def columns(self, table: str, dbname: str | None = None) -> list[SourceColumn]:
        """Columns of a source table from the database's catalogue."""
        catalog, schema, name = split_table_name(table, dbname)
        return catalogue_columns(self._load("information_schema.columns"), schema, name, catalog)

    def measured(self, table: str, columns: Sequence[SourceColumn]) -> list[SourceColumn]:
        """``columns`` with their longest texts, which the database finds: one row is fetched."""
        query = length_query(table, columns)
        found = self._load(query).first().asDict() if query else {}
        return [replace(c, max_size=found.get(c.name, c.max_size)) for c in columns]

    def read(self, table: str, key: str) -> DataFrame:
        """A whole table."""
        return self._load_parts(table, key_predicates(key, self.parts))

    def read_spans(
        self, table: str, fields: Sequence[str], spans: Sequence[tuple[date, date]], also: str | None = None
    ) -> DataFrame:
        """The rows of which a field lies in one of the spans, in parts of about equal numbers of rows; of no span, none.

        Rows of one instant stay in one part. ``also`` is a further condition on them.
        """
        if not _moments(spans):
            return self._load_parts(table, ["1 = 0"])
        # At most one row per part and field.
        found = self._load(cuts_query(table, fields, spans, self.parts, also)).collect() if self.parts > 1 else []
        cuts = [(int(r["field"]), r["start"]) for r in found]
        predicates = span_predicates(fields, spans, self.parts, cuts)
        return self._load_parts(table, [f"({p}) AND ({also})" for p in predicates] if also else predicates)

    def read_passes(
        self, table: str, fields: Sequence[str], spans: Sequence[tuple[date, date]], changed: str | None = None
    ) -> Iterator[DataFrame]:
        """The rows of ``read_spans`` in passes, each to be upserted before the next one is asked for.

        ``changed`` is the column with the time of a row's last change. A pass takes rows that changed before a mark, a
        while (``settle``) before it begins: whatever changes from then on no longer meets its conditions, so no row is in two
        parts of a pass. What it missed for that reason is in a later pass, as the time of its change is not before the
        mark. Passes get shorter; the last one is a single query and so sees one state. Together they hold every row that lies in the
        spans when the last one begins, as it is then. A row that leaves the spans meanwhile may be in as it was before: where it
        went to, the load of that period brings it.

        Without ``changed``, or if one query reads all, there is one pass.
        """
        if changed is None or self.parts == 1 or not _moments(spans):
            yield self.read_spans(table, fields, spans)
            return
        since = None
        for _ in range(MOST_PASSES):
            mark = self._load(clock_query(self.clock)).first()["moment"] - self.settle
            if since is not None and mark <= since:
                break
            yield self.read_spans(table, fields, spans, changed_between(changed, since, mark))
            since = mark
            left = f"({asked_for(fields, spans)}) AND {changed_between(changed, since, None)}"
            n = int(self._load(count_query(table, left)).first()["n"])
            if n == 0:
                return
            if n <= self.one_statement:
                break
        yield self._load_parts(table, [f"({asked_for(fields, spans)}) AND {changed_between(changed, since, None)}"])
