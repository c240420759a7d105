"""The registered queries in plain SQL, for a second engine to run on the same tables.

Written from the definitions, not derived from the DataFrame code.
"""

from __future__ import annotations

from zonepipe.operators import synth
from zonepipe.plans.queries import (
    AS_OF,
    KNOWN_UNTIL,
    KNOWN_UNTIL_ELSEWHERE,
    RUN_DAYS,
    SEED,
    STAMP,
)

PLACE = """
from events e join customer c on c.c_custkey = e.user_id
              join nation n on n.n_nationkey = c.c_nationkey
              join region r on r.r_regionkey = n.n_regionkey"""

SHARED = """
  md5(concat('ad-', cast(e.user_id as varchar))) as advertising_id, n.n_name as city,
  c.c_mktsegment as location_category, r.r_name as location_granularities,
  [e.event_type, 'gps'] as location_source, n.n_name as state,
  strftime(e.ts, '%m') as month, strftime(e.ts, '%Y-%m-%d') as "date", e.event_id as event_id"""

EPOCH = "cast(floor(epoch(e.ts)) as bigint)"
LATITUDE = "(cast(e.event_id * 7919 % 18000 as double) / 100.0) - 90.0"
LONGITUDE = "(cast(e.event_id * 104729 % 36000 as double) / 100.0) - 180.0"

ACTIVES = f"""select {SHARED}, {EPOCH} as "timestamp",
  concat('u-', cast(e.user_id * 7 + cast(floor(day(e.ts) / 10) as bigint) as varchar)) as user_id,
  {LATITUDE} as user_latitude, {LONGITUDE} as user_longitude {PLACE}"""

VIEWERSHIP = f"""select {SHARED}, p.p_type as channel_genre, p.p_brand as channel_name,
  e.event_type as device, e.event_type as device_type, cast(floor(e.value) as bigint) as duration,
  cast(1000 + e.event_id % 1001 as varchar) as grid_id, r.r_name as language,
  {EPOCH} as record_timestamp,
  case when e.event_id % 2 = 0 then 'Y' else 'N' end as show_genre,
  case when e.event_id % 3 = 0 then 'Y' else 'N' end as show_name,
  {LATITUDE} as user_lat, {LONGITUDE} as user_long {PLACE}
  join part p on p.p_partkey = e.event_id % (select count(*) from part)"""

BASE = f"with actives as ({ACTIVES}), viewership as ({VIEWERSHIP})"

FLAT = "coalesce(array_to_string(location_source, ','), '') as location_source"
DATE_AS_OF = f"date '{AS_OF}'"
OPEN = "cast(null as date)"

TRANSFORMED_ACTIVES = f"""select * replace (
    {FLAT}, sha256(advertising_id) as advertising_id, sha256(user_id) as user_id,
    try_cast("timestamp" as integer) as "timestamp", try_cast("date" as date) as "date",
    try_cast(user_latitude as decimal(10,7)) as user_latitude,
    try_cast(user_longitude as decimal(10,7)) as user_longitude) from actives"""

TRANSFORMED_VIEWERSHIP = f"""select * replace (
    {FLAT}, sha256(advertising_id) as advertising_id,
    try_cast(duration as integer) as duration, try_cast(record_timestamp as integer) as record_timestamp,
    try_cast(user_lat as decimal(10,7)) as user_lat,
    try_cast(user_long as decimal(10,7)) as user_long) from viewership"""


def known_until() -> str:
    cases = " ".join(f"when '{r}' then '{d}'" for r, d in KNOWN_UNTIL.items())
    return f"case location_granularities {cases} else '{KNOWN_UNTIL_ELSEWHERE}' end"


def run_day() -> str:
    first, second, last = RUN_DAYS
    return f"""case when "date" <= '{first}' then '{first}'
                    when "date" <= '{second}' then '{second}' else '{last}' end"""


class Dataset:
    """SQL fragments of one dataset's lookup."""

    def __init__(self, table: str, moment: str, pii: tuple[str, ...], tracked: tuple[str, ...]):
        self.table, self.moment, self.tracked = table, moment, tracked
        self.columns = list(dict.fromkeys([*pii, *tracked]))
        masks = [f"sha256({c}) as Masked_{c}" for c in pii]
        self.output = ", ".join([*self.columns, *masks])
        self.named = ", ".join([*self.columns, *[f"Masked_{c}" for c in pii]])

    def latest(self, source: str, extra_key: str = "") -> str:
        return f"""select * from (select *, row_number() over (
            partition by advertising_id{extra_key} order by {self.moment} desc, event_id desc) as rank
            from {source}) where rank = 1"""

    def history(self, name: str, source: str, run: str) -> str:
        """CTEs ending in ``name``: the lookup after one run per value of ``run``."""
        lags = "".join(f", lag({c}) over in_order as before_{c}" for c in self.tracked)
        moved = "".join(f" or {c} is distinct from before_{c}" for c in self.tracked)
        return f"""{name}_in as (select *, cast({run} as date) as run_date from {source}),
        {name}_run as ({self.latest(f'{name}_in', ', run_date')}),
        {name}_seen as (select *, lag(run_date) over in_order as before_run {lags} from {name}_run
            window in_order as (partition by advertising_id order by run_date)),
        {name}_ends as (select *, lead(run_date) over (partition by advertising_id order by run_date) as ends
            from {name}_seen where before_run is null {moved}),
        {name} as (select {self.output}, run_date as begin_date, ends as update_date,
            ends is null as flag_active from {name}_ends)"""

    def split(self) -> str:
        """CTEs ``lookup``, ``active``, ``batch`` and ``labelled`` of the feed cut by region."""
        differs = " or ".join(f"b.{c} is distinct from a.{c}" for c in self.tracked) or "false"
        return f"""{BASE},
        early as (select * from {self.table} where "date" <= {known_until()}),
        late as (select * from {self.table} where not ("date" <= {known_until()})),
        {self.history('lookup', 'early', '"date"')},
        active as (select * from lookup where flag_active),
        batch as (select {self.output} from ({self.latest('late')})),
        labelled as (select b.*, case when a.advertising_id is null then 'new'
            when {differs} then 'changed' else 'unchanged' end as status
            from batch b left join active a on a.advertising_id = b.advertising_id)"""

    def step(self) -> str:
        """CTE ``step``: open versions after the run and those it closed."""
        return f"""step as (
            select {', '.join('a.' + c for c in self.named.split(', '))}, a.begin_date,
                case when l.advertising_id is null then a.update_date else {DATE_AS_OF} end as update_date,
                l.advertising_id is null as flag_active
            from active a left join (select * from labelled where status = 'changed') l
                on l.advertising_id = a.advertising_id
            union all
            select {self.named}, {DATE_AS_OF}, {OPEN}, true from labelled where status <> 'unchanged')"""

    def merge(self) -> str:
        return f"""{self.split()}, {self.step()}
        select * from lookup where not flag_active union all by name select * from step"""


ACTIVE_IDS = Dataset("actives", '"timestamp"', ("advertising_id", "user_id"), ("user_id",))
VIEWER_IDS = Dataset("viewership", "record_timestamp", ("advertising_id",), ())
CHANNELS = Dataset("viewership", "record_timestamp", ("advertising_id",), ("channel_name",))

COMPOSITE = f"""placed as (select *, event_id % 3 as points from actives),
    comp_in as (select *, cast({run_day()} as date) as run_date from placed),
    comp_run as (select * from (select *, row_number() over (
        partition by advertising_id, city, run_date order by "timestamp" desc, event_id desc) as rank from comp_in)
        where rank = 1),
    comp_seen as (select *, lag(run_date) over w as before_run, lag(points) over w as before_points
        from comp_run window w as (partition by advertising_id, city order by run_date)),
    comp_ends as (select *, lead(run_date) over (partition by advertising_id, city order by run_date) as ends
        from comp_seen where before_run is null or points is distinct from before_points)"""

WEEK_DAY = f"""case when "date" <= '2024-01-07' then '2024-01-07' when "date" <= '2024-01-14' then '2024-01-14'
    when "date" <= '2024-01-21' then '2024-01-21' else '{AS_OF}' end"""
STORED = ACTIVE_IDS.history("stored", "actives", run_day())


def verdict(check: str, subject: str, expected: str, actual: str, passed: str) -> str:
    return f"""'{check}' as "check", '{subject}' as subject, {expected} as expected,
        {actual} as actual, {passed} as passed"""


def type_rows(source: str, types: dict[str, str]) -> str:
    spark_names = """case typeof({c}) when 'INTEGER' then 'int' when 'VARCHAR' then 'string'
        else lower(typeof({c})) end"""
    return " union all ".join(
        f"""select 'type' as "check", '{c}' as subject, '{t}' as expected,
        max({spark_names.format(c=f'"{c}"')}) as actual,
        max({spark_names.format(c=f'"{c}"')}) = '{t}' as passed from {source}"""
        for c, t in types.items()
    )


def loss_rows(source: str, types: dict[str, str]) -> str:
    return " union all ".join(
        f"""select 'cast_loss' as "check", '{c}' as subject, '0' as expected,
        cast(count(*) filter (where "{c}" is not null and try_cast("{c}" as {t}) is null) as varchar) as actual,
        count(*) filter (where "{c}" is not null and try_cast("{c}" as {t}) is null) = 0 as passed
        from {source}"""
        for c, t in types.items()
    )


class Synthetic:
    """SQL for rows derived from an event id; slices of SHA-256 digests."""

    def __init__(self, slots: int):
        blocks = -(-slots // synth.BLOCK)
        digests = ", ".join(f"sha256(concat(name, '-{b}')) as block{b}" for b in range(blocks))
        self.rows = f"""(select name, {digests} from
            (select concat('{SEED}-', cast(event_id as varchar)) as name from events))"""

    def number(self, slot: int, below: int) -> str:
        block, place = divmod(slot, synth.BLOCK)
        digits = f"substr(block{block}, {place * synth.SLOT + 1}, {synth.SLOT})"
        return f"(cast(concat('0x', {digits}) as bigint) % {below})"

    def pick(self, slot: int, words: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{w}'" for w in words)
        return f"([{listed}])[{self.number(slot, len(words))} + 1]"

    def degrees(self, slot: int, limit: int) -> str:
        return f"cast({self.number(slot, limit * 2000)} as double) / 1000.0 - cast({limit} as double)"

    def day(self, slot: int) -> str:
        return f"(date '{synth.FIRST_DAY}' + cast({self.number(slot, synth.DAYS)} as integer))"

    def epoch(self, day_slot: int, second_slot: int) -> str:
        return f"cast(epoch({self.day(day_slot)}) as bigint) + {self.number(second_slot, 86400)}"

    def select(self, columns: dict[str, str], day_slot: int) -> str:
        listed = ", ".join(f'{sql} as "{name}"' for name, sql in columns.items())
        return f"""select sha1(name) as advertising_id, {listed},
            strftime({self.day(day_slot)}, '%m') as month,
            strftime({self.day(day_slot)}, '%Y-%m-%d') as "date" from {self.rows}"""


def profiled() -> str:
    """Exact numbers of the profiled columns; estimates have to be within their error."""
    text, numbers = ("advertising_id", "channel_name"), ("duration", "record_timestamp", "user_lat")
    return " union all ".join(
        f"""select '{c}' as "column", count(*) as n_rows, count({c}) as n_values,
            {f'cast(min({c}) as double)' if c in numbers else 'cast(null as double)'} as least,
            {f'cast(max({c}) as double)' if c in numbers else 'cast(null as double)'} as most,
            true as distinct_ok, {'true' if c in numbers else 'cast(null as boolean)'} as ranks_ok from viewership"""
        for c in (*text, *numbers)
    )


def synthetic_actives() -> str:
    row = Synthetic(10)
    m = "md5(name)"
    uuid = f"""concat(substr({m},1,8), '-', substr({m},9,4), '-', substr({m},13,4), '-',
        substr({m},17,4), '-', substr({m},21,12))"""
    return row.select(
        {
            "city": row.pick(0, synth.CITIES),
            "location_category": row.pick(1, synth.PLACES),
            "location_granularities": row.pick(2, synth.GRAINS),
            "location_source": row.pick(3, synth.ORIGINS),
            "state": row.pick(4, synth.REGIONS),
            "timestamp": row.epoch(5, 6),
            "user_id": uuid,
            "user_latitude": row.degrees(7, 90),
            "user_longitude": row.degrees(8, 180),
        },
        day_slot=5,
    )


def synthetic_viewership() -> str:
    row = Synthetic(18)
    return row.select(
        {
            "channel_genre": row.pick(0, synth.GENRES),
            "channel_name": row.pick(1, synth.CHANNELS),
            "city": row.pick(2, synth.CITIES),
            "device": row.pick(3, synth.DEVICES),
            "device_type": row.pick(4, synth.DEVICE_TYPES),
            "duration": row.number(5, 1000),
            "grid_id": f"cast({row.number(6, 1001)} + 1000 as varchar)",
            "language": row.pick(7, synth.LANGUAGES),
            "location_category": row.pick(8, synth.PLACES),
            "location_granularities": row.pick(9, synth.GRAINS),
            "location_source": row.pick(10, synth.ORIGINS),
            "record_timestamp": row.epoch(11, 12),
            "show_genre": row.pick(13, synth.FLAGS),
            "show_name": row.pick(14, synth.FLAGS),
            "state": row.pick(15, synth.REGIONS),
            "user_lat": row.degrees(16, 90),
            "user_long": row.degrees(17, 180),
        },
        day_slot=11,
    )


ACTIVE_TYPES = {
    "location_source": "string",
    "timestamp": "int",
    "user_latitude": "decimal(10,7)",
    "user_longitude": "decimal(10,7)",
    "date": "date",
}
VIEWER_LOSS = {
    "duration": "integer",
    "record_timestamp": "integer",
    "user_lat": "decimal(10,7)",
    "user_long": "decimal(10,7)",
}
ACTIVE_LOSS = {
    "timestamp": "integer",
    "user_latitude": "decimal(10,7)",
    "user_longitude": "decimal(4,2)",
    "date": "date",
}
AVAILABLE, ACTIVES_AVAILABLE = (
    verdict(
        "availability", name, "'> 0'", "cast(count(advertising_id) as varchar)", "count(advertising_id) > 0"
    )
    for name in ("viewership", "actives")
)
NULL_KEYS = verdict(
    "null_key",
    "advertising_id",
    "'0'",
    "cast(count(*) - count(advertising_id) as varchar)",
    "count(*) = count(advertising_id)",
)

ORACLE: dict[str, str] = {
    "scan_zone": f"{BASE} select * replace ({FLAT}) from actives",
    "ingest_raw": f"{BASE} select * replace ({FLAT}) from viewership",
    "ingest_bytes": f"{BASE} select * replace ({FLAT}) from viewership",
    "ingest_mixed": f"""{BASE} select * replace ({FLAT}),
        case when "date" <= '{RUN_DAYS[0]}' then event_id % 10 end as only_here from actives""",
    "route_files": f"""{BASE}
        select 'actives' as dataset, 'actives_{STAMP}' as arrival, count(*) as n_rows from actives
        union all select 'viewership', 'viewership_{STAMP}', count(*) from viewership
        union all select 'unrouted', 'orders_{STAMP}', count(*) from orders""",
    "scan_shapes": f"""{BASE} select * replace ({FLAT},
        case when day(cast("date" as date)) % 3 = 2 then null else state end as state) from actives""",
    "stage_partitioned": f"{BASE} {TRANSFORMED_ACTIVES}",
    "stage_flat": f"{BASE} {TRANSFORMED_VIEWERSHIP}",
    "synth_actives": synthetic_actives(),
    "synth_viewership": synthetic_viewership(),
    "cast_decimal": f"""{BASE} select event_id, try_cast(user_latitude as decimal(10,7)) as user_latitude,
        try_cast(user_longitude as decimal(4,2)) as user_longitude from actives""",
    "flatten_array": f"{BASE} select event_id, {FLAT} from actives",
    "cast_int": f"""{BASE} select event_id, try_cast(duration as integer) as duration,
        try_cast(record_timestamp as integer) as record_timestamp from viewership""",
    "cast_date": f"""{BASE} select event_id, try_cast("date" as date) as "date" from actives""",
    "mask_columns": f"""{BASE} select event_id, sha256(advertising_id) as advertising_id,
        sha256(user_id) as user_id, sha256(cast("timestamp" as varchar)) as "timestamp" from actives""",
    "transform_actives": f"{BASE} {TRANSFORMED_ACTIVES}",
    "transform_viewership": f"{BASE} {TRANSFORMED_VIEWERSHIP}",
    "audit_columns": f"""{BASE} select event_id, advertising_id, user_id, {DATE_AS_OF} as begin_date,
        {OPEN} as update_date from actives""",
    "pii_pairs": f"""{BASE} select {ACTIVE_IDS.output}, event_id, {DATE_AS_OF} as begin_date,
        {OPEN} as update_date from actives""",
    "swap_masked": f"""{BASE} select sha256(advertising_id) as advertising_id,
        sha256(user_id) as user_id, event_id, city from actives""",
    "dedupe_batch": f"""{BASE} select advertising_id, user_id, "timestamp", event_id
        from ({ACTIVE_IDS.latest('actives')})""",
    "scd2_initial": f"""{BASE} select {ACTIVE_IDS.output}, {DATE_AS_OF} as begin_date,
        {OPEN} as update_date, true as flag_active from ({ACTIVE_IDS.latest('actives')})""",
    "scd2_classify": f"{ACTIVE_IDS.split()} select * from labelled",
    "scd2_new_keys": f"{ACTIVE_IDS.split()} select * exclude (status) from labelled where status = 'new'",
    "scd2_change_rows": f"{ACTIVE_IDS.split()} select * exclude (status) from labelled where status = 'changed'",
    "scd2_changes": f"{ACTIVE_IDS.split()} select * exclude (status) from labelled where status <> 'unchanged'",
    "scd2_change_summary": f"""{ACTIVE_IDS.split()} select
        count(*) filter (where status = 'new') as n_new,
        count(*) filter (where status = 'changed') as n_changed,
        count(*) filter (where status = 'unchanged') as n_unchanged from labelled""",
    "scd2_closed": f"{ACTIVE_IDS.split()}, {ACTIVE_IDS.step()} select * from step where not flag_active",
    "scd2_inserted": f"""{ACTIVE_IDS.split()} select {ACTIVE_IDS.named}, {DATE_AS_OF} as begin_date,
        {OPEN} as update_date, true as flag_active from labelled where status <> 'unchanged'""",
    "scd2_merge_actives": ACTIVE_IDS.merge(),
    "scd2_merge_viewership": VIEWER_IDS.merge(),
    "scd2_merge_channel": CHANNELS.merge(),
    "scd2_merge_composite": f"""{BASE}, {COMPOSITE}
        select advertising_id, sha256(advertising_id) as Masked_advertising_id, city,
            cast(points as varchar) as points, run_date as begin_date, ends as update_date,
            ends is null as flag_active from comp_ends""",
    "scd2_history": f"""{BASE}, {ACTIVE_IDS.history('versions', 'actives', '"date"')} select * from versions""",
    "scd2_history_channel": f"""{BASE}, {CHANNELS.history('versions', 'viewership', '"date"')}
        select * from versions""",
    "lookup_update": f"""{BASE}, {STORED}
        select row_number() over (order by run_date) as version, cast(run_date as varchar) as as_of,
            count(*) filter (where before_run is null) as n_new,
            count(*) filter (where before_run is not null and user_id is distinct from before_user_id) as n_changed,
            count(*) filter (where before_run is not null and user_id is not distinct from before_user_id)
                as n_unchanged
        from stored_seen group by run_date""",
    "lookup_scan": f"{BASE}, {STORED} select * from stored",
    "lookup_replay": f"{BASE}, {STORED} select * from stored",
    "lookup_compact": f"{BASE}, {STORED} select * from stored",
    "lookup_late": f"{BASE}, {STORED} select * from stored",
    "lookup_late_daily": f"{BASE}, {CHANNELS.history('weekly', 'viewership', WEEK_DAY)} select * from weekly",
    "lookup_active": f"{BASE}, {STORED} select * from stored where flag_active",
    "validate_counts": f"{BASE} select count(*) as n_rows, count(advertising_id) as n_values from actives",
    "count_by_partition": f"""{BASE} select month, cast("date" as date) as "date", count(*) as n_rows,
        count(advertising_id) as n_values from actives group by all""",
    "validate_availability": f"{BASE} select {AVAILABLE} from viewership",
    "validate_reconcile": f"""{BASE}, transformed as ({TRANSFORMED_ACTIVES}),
        raw as (select count(advertising_id) as n from actives)
        select 'reconcile' as "check", 'actives' as subject, cast(max(raw.n) as varchar) as expected,
            cast(count(transformed.advertising_id) as varchar) as actual,
            max(raw.n) = count(transformed.advertising_id) as passed from transformed, raw""",
    "validate_types": f"{BASE}, transformed as ({TRANSFORMED_ACTIVES}) {type_rows('transformed', ACTIVE_TYPES)}",
    "validate_cast_loss": f"{BASE} {loss_rows('actives', ACTIVE_LOSS)}",
    "validate_raw": f"""{BASE} select {AVAILABLE} from viewership union all
        {loss_rows('viewership', VIEWER_LOSS)} union all select {NULL_KEYS} from viewership""",
    "validate_arrivals": f"""{BASE} select 'availability' as "check", 'actives_{STAMP}_' || number as subject,
            '> 0' as expected, cast(count(day) as varchar) as actual, count(day) > 0 as passed
        from (values ('0', '{RUN_DAYS[0]}'), ('1', '{RUN_DAYS[1]}'), ('2', '{RUN_DAYS[2]}'), ('3', 'none')) as a(number, arrived)
        left join (select {run_day()} as day from actives where advertising_id is not null) on day = arrived
        group by number""",
    "profile_arrivals": f"{BASE} {profiled()}",
    "validate_staging": f"""{BASE}, transformed as ({TRANSFORMED_ACTIVES}),
        raw as (select count(advertising_id) as n from actives)
        select {ACTIVES_AVAILABLE} from transformed union all
        select 'reconcile', 'actives', cast(max(raw.n) as varchar),
            cast(count(transformed.advertising_id) as varchar),
            max(raw.n) = count(transformed.advertising_id) from transformed, raw union all
        {type_rows('transformed', ACTIVE_TYPES)}""",
    "run_actives": f"""{BASE} select {ACTIVE_IDS.output}, {DATE_AS_OF} as begin_date,
        {OPEN} as update_date, true as flag_active from ({ACTIVE_IDS.latest('actives')})""",
    "run_viewership": f"{BASE} {TRANSFORMED_VIEWERSHIP}",
    "stream_ingest": f"{BASE} {TRANSFORMED_ACTIVES}",
    "stream_dedup": f"{BASE} {TRANSFORMED_ACTIVES}",
    "stream_route": f"""{BASE}, transformed_actives as ({TRANSFORMED_ACTIVES}),
        transformed_viewership as ({TRANSFORMED_VIEWERSHIP})
        select 'actives' as dataset, event_id, advertising_id, location_source, cast("date" as varchar) as "date"
        from transformed_actives union all
        select 'viewership', event_id, advertising_id, location_source, cast("date" as varchar) from transformed_viewership""",
    "compact_staging": f"{BASE} {TRANSFORMED_ACTIVES}",
    "run_arrivals": f"{BASE}, {STORED} select * from stored",
    "run_arrivals_staging": f"{BASE} {TRANSFORMED_ACTIVES}",
    "run_corrected": f"{BASE} {TRANSFORMED_ACTIVES}",
    "run_corrected_lookup": f"{BASE}, {STORED} select * from stored",
    "run_manifest": f"""{BASE}, numbered as (select *, 'actives_{STAMP}_' || (case {run_day()}
            when '{RUN_DAYS[0]}' then '0' when '{RUN_DAYS[1]}' then '1' else '2' end) as arrival from actives)
        select arrival, concat('month=', month, '/date=', "date", '/arrival=', arrival) as folder,
            count(*) as n_rows, count(advertising_id) as n_values from numbered group by month, "date", arrival""",
    "stream_lookup": f"{BASE}, {STORED} select * from stored",
}
