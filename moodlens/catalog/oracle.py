"""The registered queries in plain SQL over the given tables.

Each query is put together from the common tables it needs.
"""

from __future__ import annotations

from moodlens.catalog.fixtures import LEXICON_ROWS, RING_VERTICES
from moodlens.functions.stem import STEP_2, STEP_3, STEP_4
from moodlens.operators.terms import STOP_WORDS


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in row) + ")" for row in rows)


def _lat(key: str) -> str:
    n = f"(2400 + {key} * 7919 % 2600)"
    return f"concat({n} // 100, '.', lpad(cast({n} % 100 as varchar), 2, '0'))"


def _lon(key: str) -> str:
    n = f"(12500 - {key} * 104729 % 5900)"
    return f"concat('-', {n} // 100, '.', lpad(cast({n} % 100 as varchar), 2, '0'))"


_OFF_TIE = "1e-8"
_SIGNS = r"regexp_replace({}, '@[A-Za-z0-9]+|[^0-9A-Za-z \t] | \w+: /  / \S+', ' ', 'g')"
# The pattern of cleaning, which must equal that of moodlens.functions.text, and white space by code point.
_SPACES = r"[\s\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_FLAT = r"regexp_replace({}, '[\t\r\n]+', ' ', 'g')"


def _clean(column: str) -> str:
    return f"trim(regexp_replace({_SIGNS.format(column)}, '{_SPACES}', ' ', 'g'))"


def _located(points: str, edges: str, regions: str) -> str:
    """Region of every point by testing it against every edge."""
    return f"""select p.location, p.lat, p.lon, coalesce(r.region_name, 'Unknown') as region_name,
                  coalesce(r.region_code, 'Unknown') as region_code
           from {points} p
           left join (
             select location, min(ordinal) as ordinal from (
               select p.location, e.ordinal from {points} p join {edges} e on p.lat is not null
               group by p.location, e.ordinal
               having count(*) filter ((y1 > lat) <> (y2 > lat)
                        and (y2 > y1) = ((x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1) > 0)) % 2 = 1
                  and count(*) filter (lon between least(x1, x2) and greatest(x1, x2)
                        and lat between least(y1, y2) and greatest(y1, y2)
                        and (x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1) = 0) = 0)
             group by location) h on h.location = p.location
           left join (select distinct ordinal, region_name, region_code from {regions}) r on r.ordinal = h.ordinal"""


# degrees by which the regions are moved; the same number as in the queries
MOVED_EAST = 275

# name -> (common tables it needs, SQL)
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "lexicon": ((), f"select * from (values {_values(LEXICON_ROWS)}) as l(term, polarity)"),
    "tweets": (
        (),
        f"""select cast(e.user_id as varchar) as user_id, cast(e.event_id as varchar) as tweet_id, d.doc_id,
            d.text as tweet, case when e.value >= 1 then e.ts end as "timestamp",
            case when e.event_type = 'error' then 'n/a'
                 else concat({_lat('e.event_id')}, ',', {_lon('e.event_id')}) end as location
            from events e join documents d on d.doc_id = e.event_id * 7919 % (select count(*) from documents)""",
    ),
    "scores": (
        ("lexicon",),
        f"""select doc_id, sum(polarity) / count(*) as score from (
              select doc_id, unnest(regexp_extract_all(lower({_clean('text')}), '[a-z]+')) as term from documents) t
            join lexicon using (term) group by doc_id""",
    ),
    "words": (
        (),
        f"""select doc_id, unnest(regexp_extract_all(lower({_clean('text')}), '[a-z]+')) as term from documents""",
    ),
    "word_scores": (
        ("words",),
        """select doc_id, sum(((length(term) * 7 + ascii(term)) % 17 - 8) / 8.0) / count(*) as score from words group by doc_id""",
    ),
    "scored": (
        ("tweets", "scores"),
        """select t.*, coalesce(s.score, 0.0) as tweet_sentiment
           from tweets t left join scores s on s.doc_id = t.doc_id""",
    ),
    "vertices": (
        (),
        f"""select n_nationkey as ordinal, n_name as region_name, concat('N', n_nationkey) as region_code, ring_id, seq,
            cast(-119.0 + n_nationkey % 5 * 12 + dx as double) as lon,
            cast(27.0 + n_nationkey // 5 * 5 + dy as double) as lat
            from nation, (values {_values(RING_VERTICES)}) as v(ring_id, seq, dx, dy)
            where ring_id = 0 or (ring_id = 1 and n_regionkey in (1, 3)) or (ring_id = 2 and n_regionkey = 4)""",
    ),
    "edges": (
        ("vertices",),
        """select a.ordinal, a.lon as x1, a.lat as y1, b.lon as x2, b.lat as y2
           from vertices a join vertices b on a.ordinal = b.ordinal and a.ring_id = b.ring_id
                and b.seq = (a.seq + 1) % 4 + case when a.ring_id = 0 and a.seq in (3, 4, 5, 6) then 4 else 0 end""",
    ),
    "points": (
        ("tweets",),
        """select location, try_cast(split_part(location, ',', 1) as double) as lat,
                  try_cast(split_part(location, ',', 2) as double) as lon
           from (select distinct location from tweets)""",
    ),
    "located": (("points", "edges", "vertices"), _located("points", "edges", "vertices")),
    "ridge": (
        (),
        """select -1 as ordinal, 'Ridge' as region_name, 'R' as region_code, seq, lon, lat from (
             select cast(c_custkey as bigint) + 1 as seq,
                    cast(-100.0 as double) + cast(c_custkey as double) * 2 / (select max(c_custkey) + 1 from customer) as lon,
                    cast(37.5 as double) + cast(cast(c_custkey as bigint) * 7919 % 97 as double) / 97 as lat from customer
             union all select 0, -100.5, 36.875 union all select max(c_custkey) + 3, -97.5, 36.875 from customer)""",
    ),
    "crowded_vertices": (
        ("vertices", "ridge"),
        """select ordinal, region_name, region_code from vertices union all select ordinal, region_name, region_code from ridge""",
    ),
    "crowded_edges": (
        ("edges", "ridge"),
        """select * from edges union all
           select ordinal, lon, lat, coalesce(lead(lon) over r, first(lon) over r), coalesce(lead(lat) over r, first(lat) over r)
           from ridge window r as (order by seq)""",
    ),
    "moved_points": (
        ("tweets",),
        f"""select location, try_cast(split_part(location, ',', 1) as double) as lat, try_cast(split_part(location, ',', 2) as double) as lon
            from (select case when location = 'n/a' then location else concat(split_part(location, ',', 1), ',',
                    case when h < 0 then '-' else '' end, abs(h) // 100, '.', lpad(cast(abs(h) % 100 as varchar), 2, '0')) end as location
                  from (select location, case when e > 18000 then e - 36000 else e end as h
                        from (select distinct location,
                                cast(round(try_cast(split_part(location, ',', 2) as decimal(10, 2)) * 100) as bigint) + {100 * MOVED_EAST} as e from tweets)))""",
    ),
    "moved_edges": (
        ("edges",),
        f"""select ordinal, x1 + {MOVED_EAST} + turn as x1, y1, x2 + {MOVED_EAST} + turn as x2, y2 from edges, (values (0), (-360)) as t(turn)""",
    ),
    "sentiment_located": (
        ("scored", "located"),
        "select s.*, l.region_name, l.region_code from scored s join located l on l.location = s.location",
    ),
    "windowed": (
        ("sentiment_located",),
        """select region_name as state, tweet_sentiment as sentiment,
                  (epoch_us(ts) // 5000000 - k) * 5000000 as start_us, ts
           from (select *, {ts} as ts from sentiment_located where "timestamp" is not null), range(4) as r(k)""",
    ),
}


def _with(needed: tuple[str, ...], sql: str, **fill: str) -> str:
    """``sql`` preceded by the common tables it needs, each once and after those it builds on."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in _TABLES[name][0]:
                visit(other)
            order.append(name)

    for name in needed:
        visit(name)
    tables = []
    for name in order:
        body = _TABLES[name][1]
        for key, value in fill.items():
            body = body.replace("{" + key + "}", value)
        tables.append(f"{name} as ({body})")
    return f"with {', '.join(tables)} {sql}" if tables else sql


def _measures(counted: str, sentiment: str = "tweet_sentiment") -> str:
    return f"""cast(count({counted}) as bigint) as count, round(sum({sentiment}) + {_OFF_TIE}, 6) as total_sentiment,
        round(sum(abs({sentiment})) + {_OFF_TIE}, 6) as absolute_sentiment, round(avg({sentiment}) + {_OFF_TIE}, 6) as mean_sentiment"""


_HOUR = 'cast(hour("timestamp") as integer)'
_DAY = 'cast(isodow("timestamp") - 1 as integer)'
_DAY_NAME = 'dayname("timestamp")'
_LENGTH = "cast(length({}) // 10 * 10 as bigint)"
_STATE_MEASURES = f"""cast(count(location) as bigint) as count, round(sum(tweet_sentiment) + {_OFF_TIE}, 6) as total_sentiment,
    round(sum(abs(tweet_sentiment)) + {_OFF_TIE}, 6) as absolute_sentiment,
    round(sum(tweet_sentiment) / nullif(count(location), 0) + {_OFF_TIE}, 6) as mean_sentiment"""

_BY_STATE = f"""select region_name as state_name, region_code as state_code, {_STATE_MEASURES}
    from sentiment_located group by region_name, region_code"""

_SUMMARY = f"""
    select 'state' as facet, region_name as state_name, region_code as state_code, cast(null as integer) as hour,
           cast(null as varchar) as day_name, cast(null as integer) as day_number, cast(null as bigint) as tweet_length,
           {_STATE_MEASURES} from sentiment_located group by region_name, region_code
    union all
    select 'hour', null, null, {_HOUR}, null, null, null, {_measures(_HOUR)} from scored group by {_HOUR}
    union all
    select 'day', null, null, null, {_DAY_NAME}, {_DAY}, null, {_measures(_DAY)} from scored group by {_DAY_NAME}, {_DAY}
    union all
    select 'length', null, null, null, null, null, {_LENGTH.format('tweet')}, {_measures('tweet')} from scored
    group by {_LENGTH.format('tweet')}"""

_BY_LENGTH = f"""select {_LENGTH.format('tweet')} as tweet_length, {_measures('tweet')}
    from scored group by {_LENGTH.format('tweet')}"""


def _length_facet(table: str) -> str:
    """The length facet of one table's texts, with the stored types."""
    return f"""select cast(tweet_length as integer) as tweet_length, cast(count(*) as bigint) as count,
          cast(round(sum(score) + {_OFF_TIE}, 6) as float) as total_sentiment,
          cast(round(sum(abs(score)) + {_OFF_TIE}, 6) as float) as absolute_sentiment,
          cast(round(avg(score) + {_OFF_TIE}, 6) as float) as mean_sentiment
        from (select any_value({_LENGTH.format('text')}) as tweet_length,
                coalesce(sum(polarity) / nullif(count(polarity), 0), 0.0) as score
              from (select row_id, text, unnest(case when len(tokens) = 0 then [''] else tokens end) as term
                    from (select row_number() over () as row_id, text,
                            regexp_extract_all(lower({_clean('text')}), '[a-z]+') as tokens from {table}))
              left join lexicon using (term) group by row_id)
        group by tweet_length"""


_USERS = f"""select cast(user_id as varchar) as user_id, cast({_lat('user_id')} as double) as latitude,
    cast({_lon('user_id')} as double) as longitude from (select distinct user_id from events)"""

_RAW = f"""select user_id, tweet_id, {_FLAT.format('tweet')} as tweet,
    coalesce(strftime("timestamp", '%Y-%m-%dT%H:%M:%S'), '') as "timestamp" """

_MS = """make_timestamp(epoch_us("timestamp") // 1000 * 1000)"""
_WINDOW_BOUNDS = "make_timestamp(start_us) as window_start, make_timestamp(start_us + 20000000) as window_end"
_CLOSED = "where start_us + 20000000 <= (select max(epoch_us(ts)) from windowed) - 5000000"
_MEAN_MAX_MIN = f"""round(avg(sentiment) + {_OFF_TIE}, 6) as mean_sentiment, round(max(sentiment) + {_OFF_TIE}, 6) as max_sentiment,
    round(min(sentiment) + {_OFF_TIE}, 6) as min_sentiment"""

ORACLE_SQL: dict[str, str] = {
    "sentiment_by_state": _with(("sentiment_located",), _BY_STATE),
    "sentiment_by_state_two_level": _with(("sentiment_located",), _BY_STATE),
    "tweets_scan": _with(("tweets",), 'select user_id, tweet_id, tweet, "timestamp", location from tweets'),
    "tweet_count": _with(("tweets",), "select count(*) as tweets from tweets"),
    "tweets_of_user": _with(
        ("tweets",), """select user_id, tweet_id, tweet, "timestamp", location from tweets where user_id = '7'"""
    ),
    "tweets_clean": _with(("tweets",), f"select tweet_id, {_clean('tweet')} as clean_tweet from tweets"),
    "tweet_sentiment": _with(("scored",), "select tweet_id, tweet_sentiment from scored"),
    "tweet_time_parts": _with(
        ("tweets",),
        f"""select tweet_id, cast(year("timestamp") as integer) as timestamp_year,
            cast(month("timestamp") as integer) as timestamp_month, cast(day("timestamp") as integer) as timestamp_day,
            {_HOUR} as timestamp_hour, {_DAY} as timestamp_day_of_week, {_DAY_NAME} as day_name from tweets""",
    ),
    "sentiment_by_location": _with(
        ("scored",), f"select location, {_measures('location')} from scored group by location"
    ),
    "sentiment_by_hour": _with(("scored",), f"select {_HOUR} as hour, {_measures(_HOUR)} from scored group by {_HOUR}"),
    "sentiment_by_day_of_week": _with(
        ("scored",),
        f"""select {_DAY_NAME} as day_name, {_DAY} as day_number, {_measures(_DAY)}
            from scored group by {_DAY_NAME}, {_DAY}""",
    ),
    "sentiment_by_length": _with(("scored",), _BY_LENGTH),
    "region_lookup": _with(("located",), "select location, lat, lon, region_name, region_code from located"),
    "region_lookup_shuffled": _with(
        ("located",),
        "select t.tweet_id, l.region_name, l.region_code from tweets t join located l on l.location = t.location",
    ),
    "region_lookup_crowded": _with(("points", "crowded_edges", "crowded_vertices"), _located("points", "crowded_edges", "crowded_vertices")),
    "region_lookup_antimeridian": _with(
        ("moved_points", "moved_edges", "vertices"), _located("moved_points", "moved_edges", "vertices")
    ),
    "facet_summary": _with(("sentiment_located",), _SUMMARY),
    "facet_previews": _with(
        ("sentiment_located",),
        f"""select * exclude (place) from (
              select *, row_number() over (partition by facet order by coalesce(hour, day_number, tweet_length) nulls first) as place
              from ({_SUMMARY}))
            where place <= case facet when 'state' then 51 when 'hour' then 24 when 'day' then 20 else 28 end""",
    ),
    "tweet_sentiment_large_lexicon": _with(
        ("tweets", "word_scores"),
        "select t.tweet_id, coalesce(s.score, 0.0) as tweet_sentiment from tweets t left join word_scores s on s.doc_id = t.doc_id",
    ),
    "stored_tweets": _with(("tweets",), 'select user_id, tweet_id, tweet, "timestamp", location from tweets'),
    "stored_tweets_of_user": _with(
        ("tweets",), """select user_id, tweet_id, tweet, "timestamp", location from tweets where user_id = '7'"""
    ),
    "regions_loaded": _with(
        ("vertices",),
        """select cast(ordinal as bigint) as rank, region_name, region_code,
                  cast(case ring_id when 2 then 1 else ring_id end as integer) as ring_id, cast(seq as integer) as seq, lon, lat from vertices""",
    ),
    "region_lookup_geojson": _with(("located",), "select location, lat, lon, region_name, region_code from located"),
    "historical_stores": _with(
        ("sentiment_located",),
        f"""select facet || '_reduced' as store,
                coalesce(state_name, cast(hour as varchar), day_name, cast(tweet_length as varchar)) as key, count,
                round(cast(total_sentiment as float), 3) as total_sentiment, round(cast(absolute_sentiment as float), 3) as absolute_sentiment,
                round(cast(mean_sentiment as float), 3) as mean_sentiment
            from ({_SUMMARY})""",
    ),
    "feed_export": _with(
        ("tweets",),
        f"""select u.user_id, u.latitude, u.longitude, t.tweet_id, {_FLAT.format('t.tweet')} as tweet,
            coalesce(strftime(t."timestamp", '%Y-%m-%dT%H:%M:%S'), '') as "timestamp",
            concat(cast(u.latitude as varchar), ',', cast(u.longitude as varchar)) as location
            from ({_USERS}) u join tweets t on t.user_id = u.user_id where t.location <> 'n/a'""",
    ),
    "feed_rejects": _with(
        ("tweets",), f"{_RAW}, 'field count' as rejected_because from tweets where location = 'n/a'"
    ),
    "replay_topic": _with(
        ("tweets",),
        """select user_id, tweet_id, tweet, location, '1706745600000' as timestamp_logger
           from tweets order by tweet_id limit 100""",
    ),
    "stream_malformed": _with(("tweets",), "select concat('{broken ', tweet_id) as value from tweets where location = 'n/a'"),
    "stream_late_rows": _with(
        ("windowed",),
        f"""select state, {_WINDOW_BOUNDS}, {_MEAN_MAX_MIN} from windowed
            where epoch_ms(ts) >= (select (min(epoch_ms(ts)) + max(epoch_ms(ts))) // 2 from windowed)
              and start_us + 20000000 <= (select max(epoch_us(ts)) from windowed) - 5000000
            group by state, start_us""",
        ts=_MS,
    ),
    "user_tweet_join": _with(
        ("tweets",),
        f"""select u.user_id, u.latitude, u.longitude, t.tweet_id, t.tweet, t."timestamp",
            concat(cast(u.latitude as varchar), ',', cast(u.longitude as varchar)) as location
            from ({_USERS}) u join tweets t on t.user_id = u.user_id""",
    ),
    "parse_users": _USERS,
    "raw_tweets_valid": _with(("tweets",), f"{_RAW} from tweets where location <> 'n/a'"),
    "raw_tweets_rejected": _with(
        ("tweets",), f"{_RAW}, 'field count' as rejected_because from tweets where location = 'n/a'"
    ),
    "tsv_ingest_valid": _with(
        ("tweets",),
        """select user_id, tweet_id, tweet, "timestamp", location
            from tweets where "timestamp" is not null""",
    ),
    "tsv_ingest_rejected": _with(
        ("tweets",),
        """select user_id, tweet_id, tweet, 'no time' as timestamp_text, location,
            'timestamp' as rejected_because from tweets where "timestamp" is null""",
    ),
    "facet_store_conform": _with(
        ("sentiment_located",),
        f"""select state_name, state_code, count, cast(total_sentiment as float) as total_sentiment,
            cast(absolute_sentiment as float) as absolute_sentiment, cast(mean_sentiment as float) as mean_sentiment
            from ({_BY_STATE})""",
    ),
    "facet_upsert": _with(
        ("lexicon",),
        f"""select coalesce(n.tweet_length, o.tweet_length) as tweet_length, coalesce(n.count, o.count) as count,
            coalesce(n.total_sentiment, o.total_sentiment) as total_sentiment,
            coalesce(n.absolute_sentiment, o.absolute_sentiment) as absolute_sentiment,
            coalesce(n.mean_sentiment, o.mean_sentiment) as mean_sentiment
            from ({_length_facet('conversations')}) o full join ({_length_facet('documents')}) n
            on n.tweet_length = o.tweet_length""",
    ),
    "json_round_trip": _with(
        ("tweets",), f'select user_id, tweet_id, tweet, "timestamp", location, {_MS} as date_time from tweets'
    ),
    "replay_sample": _with(
        ("tweets",),
        """select user_id, tweet_id, tweet, location, '1706745600000' as timestamp_logger
           from tweets order by tweet_id limit 100""",
    ),
    "window_sentiment_batch": _with(
        ("windowed",),
        f"select state, {_WINDOW_BOUNDS}, {_MEAN_MAX_MIN} from windowed group by state, start_us",
        ts='"timestamp"',
    ),
    "stream_window_sentiment": _with(
        ("windowed",),
        f"select state, {_WINDOW_BOUNDS}, {_MEAN_MAX_MIN} from windowed {_CLOSED} group by state, start_us",
        ts=_MS,
    ),
    "stream_window_total": _with(
        ("windowed",),
        f"""select state, {_WINDOW_BOUNDS}, round(sum(sentiment) + {_OFF_TIE}, 6) as total_sentiment,
            round(sum(abs(sentiment)) + {_OFF_TIE}, 6) as absolute_sentiment from windowed {_CLOSED} group by state, start_us""",
        ts=_MS,
    ),
    "stream_raw": _with(
        ("sentiment_located",),
        f"""select location, region_name as state, tweet, tweet_sentiment as sentiment, {_MS} as date_time
            from sentiment_located""",
    ),
    "term_counts": _with(
        ("tweets",),
        rf"""select term, count(*) as count from (
              select unnest(regexp_extract_all(lower(tweet), '[\p{{L}}\p{{N}}]+(?:''[\p{{L}}\p{{N}}]+)*')) as term
              from tweets)
            where term not in ({', '.join(f"'{word}'" for word in STOP_WORDS)}) group by term""",
    ),
}

_LAST = "(select max(epoch_us(ts)) from windowed)"
_MIDDLE = "(select (min(epoch_ms(ts)) + max(epoch_ms(ts))) // 2 from windowed)"

ORACLE_SQL |= {
    # other ways to the same rows
    "tweet_sentiment_joined": ORACLE_SQL["tweet_sentiment_large_lexicon"],
    "tweet_count_observed": ORACLE_SQL["tweet_count"],
    "historical_incremental": ORACLE_SQL["historical_stores"],
    "stream_pane_windows": ORACLE_SQL["stream_window_sentiment"],
    "replay_stream": _with(
        ("tweets",),
        """select user_id, tweet_id, tweet, location, cast(1706745600000 + 10000 * send as varchar) as timestamp_logger
           from (select * from tweets order by tweet_id limit 100), range(3) as s(send)""",
    ),
    "stream_large_lexicon": _with(
        ("tweets", "word_scores"),
        f"""select t.location, coalesce(s.score, 0.0) as sentiment, {_MS} as date_time
            from tweets t left join word_scores s on s.doc_id = t.doc_id""",
    ),
    "stream_upsert": _with(
        ("windowed",),
        f"""select state, {_WINDOW_BOUNDS}, count(*) as count, {_MEAN_MAX_MIN}, round(sum(sentiment) + {_OFF_TIE}, 6) as total_sentiment,
            round(sum(abs(sentiment)) + {_OFF_TIE}, 6) as absolute_sentiment, start_us + 20000000 > {_LAST} - 5000000 as is_open
            from windowed where epoch_ms(ts) >= {_MIDDLE} or start_us + 20000000 > {_LAST} - 5000000 group by state, start_us""",
        ts=_MS,
    ),
    "stream_late_quarantine": _with(
        ("windowed",),
        f"""select location, region_name as state, tweet_sentiment as sentiment, date_time, missed from (
              select *, cast(case when date_time is null then 4
                        when epoch_ms(date_time) >= {_MIDDLE} then 0
                        else greatest(0, least(4, floor(({_LAST} // 1000 - 5000 - epoch_ms(date_time) // 5000 * 5000) / 5000))) end as integer) as missed
              from (select *, {_MS} as date_time from sentiment_located))
            where missed > 0""",
        ts=_MS,
    ),
}


def _count_of_runs(text: str) -> str:
    """How often a consonant follows a run of vowels."""
    kinds = f"regexp_replace(regexp_replace({text}, '[aeiouy]+', '1', 'g'), '[^1]+', '0', 'g')"
    return f"(length({kinds}) - length(replace({kinds}, '10', ''))) // 2"


def _rule(suffix: str, ending: str, least: int, more: str = "") -> str:
    front = f"left(w, {-len(suffix)})"
    return f"when suffix(w, '{suffix}') {more} then case when {_count_of_runs(front)} >= {least} then {front} || '{ending}' else w end"


def _rules(rules, least: int) -> str:
    return " ".join(_rule(suffix, ending, least) for suffix, ending in sorted(rules, key=lambda rule: -len(rule[0])))


_FRONT = "left(w, -1)"
_SHORT = f"regexp_matches({_FRONT}, '[^aeiouy][aeiouy][^aeiouywxY]$')"
_TWICE = f"left(right({_FRONT}, 2), 1) = right({_FRONT}, 1) and length({_FRONT}) > 1"
_HAS_VOWEL = "regexp_matches({}, '[aeiouy]')"

# what each step makes of the word w; a trailing sign marks a word that lost -ed or -ing
_STEM_STEPS = (
    "case when suffix(w, 'sses') or suffix(w, 'ies') then left(w, -2) when suffix(w, 's') and not suffix(w, 'ss') then left(w, -1) else w end",
    f"""case when suffix(w, 'eed') then case when {_count_of_runs("left(w, -3)")} > 0 then left(w, -1) else w end
             when suffix(w, 'ed') then case when {_HAS_VOWEL.format("left(w, -2)")} then left(w, -2) || '+' else w end
             when suffix(w, 'ing') and {_HAS_VOWEL.format("left(w, -3)")} then left(w, -3) || '+' else w end""",
    f"""case when not suffix(w, '+') then w
             when suffix(w, 'at+') or suffix(w, 'bl+') or suffix(w, 'iz+') then {_FRONT} || 'e'
             when {_TWICE} and not regexp_matches({_FRONT}, '[aeiouylsz]$') then left(w, -2)
             when {_count_of_runs(_FRONT)} = 1 and {_SHORT} then {_FRONT} || 'e' else {_FRONT} end""",
    f"case when lower(right(w, 1)) = 'y' and {_HAS_VOWEL.format(_FRONT)} then {_FRONT} || 'i' else w end",
    f"case {_rules(STEP_2, 1)} else w end",
    f"case {_rules(STEP_3, 1)} else w end",
    f"""case {_rule("ion", "", 2, "and regexp_matches(w, '[st]ion$')")}
             {_rules([(suffix, "") for suffix in STEP_4 if suffix != "ion"], 2)} else w end""",
    f"case when suffix(w, 'e') and ({_count_of_runs(_FRONT)} > 1 or {_count_of_runs(_FRONT)} = 1 and not {_SHORT}) then {_FRONT} else w end",
    f"case when suffix(w, 'll') and {_count_of_runs('w')} > 1 then {_FRONT} else w end",
)


def _stems() -> str:
    word = "case when regexp_full_match(term, '[a-z]{3,}') then regexp_replace(term, '(^|[aeiouy])y', '\\1Y', 'g') end"
    query = f"select term, count, {word} as w from counted"
    for step in _STEM_STEPS:
        query = f"select term, count, {step} as w from ({query})"
    return f"select coalesce(lower(w), term) as term, count from ({query})"


_TERMS = r"""select term, count(*) as count from (
               select unnest(regexp_extract_all(lower(tweet), '[\p{L}\p{N}]+(?:''[\p{L}\p{N}]+)*')) as term from tweets) group by term"""
_REUSED = """select case when cast(tweet_id as bigint) % 3 = 0 then '7' when location <> 'n/a' then user_id end as user_id,
                    tweet_id, tweet, "timestamp", location from tweets"""

ORACLE_SQL |= {
    "stemmed_term_counts": _with(
        ("tweets",),
        f"""select term, cast(sum(count) as bigint) as count from (with counted as ({_TERMS}) {_stems()})
            where term not in ({', '.join(f"'{word}'" for word in STOP_WORDS)}) group by term""",
    ),
    "clustered_store": _with(("tweets",), _REUSED),
    "clustered_tweets_of_user": _with(("tweets",), f"select * from ({_REUSED}) where user_id = '7'"),
    "clustered_user_join": _with(
        ("tweets",),
        f"""select u.user_id, u.latitude, u.longitude, t.tweet_id, t.tweet, t."timestamp",
            concat(cast(u.latitude as varchar), ',', cast(u.longitude as varchar)) as location
            from ({_USERS}) u join ({_REUSED}) t on t.user_id = u.user_id""",
    ),
}
