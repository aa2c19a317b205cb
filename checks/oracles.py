"""The registered queries once more, as plain SQL for DuckDB."""

from __future__ import annotations

from checks.views import VIEWS

_NAME_KEYS = ["passport", "email", "fullname", "telfnumber", "name", "last_name", "address"]
_STRONG_KEYS = ["passport", "email", "fullname", "telfnumber", "address"]
_FIELDS = [
    "name", "last_name", "sex", "telfnumber", "passport", "email", "fullname", "city", "address",
    "company", "company_address", "company_telfnumber", "company_email", "job", "IBAN", "salary",
    "IPv4",
]

_CLEAN_NAME = r"""array_to_string(list_transform(regexp_extract_all(trim(regexp_replace(
    regexp_replace(lower(name), '\b(mr|mrs|ms|sr|sra|dr|dott|sig|mtro)\b', '', 'g'),
    '[().]', '', 'g')), '\p{L}+|\P{L}+'), lambda x: upper(x[1]) || substr(x, 2)), '')"""


def _phone(c: str) -> str:
    return f"regexp_replace({c}, '[^+0-9]', '', 'g')"


def _melt(source: str, record_id: str, keys: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {record_id} AS id, {pos} AS pos, '{k}' AS key, CAST({k} AS VARCHAR) AS value"
        f" FROM {source} WHERE {k} <> ''"
        for pos, k in enumerate(keys)
    )


def _record_part(source: str, place: int, fields: list[str]) -> str:
    columns = ", ".join(
        f if f in fields else f"CAST(NULL AS VARCHAR) AS {f}" for f in _FIELDS
    )
    return f"SELECT ord * 5 + {place} AS record_id, {columns} FROM {source}"


_RECORDS = " UNION ALL ".join(
    [
        _record_part("c_personal", 0, ["name", "last_name", "sex", "telfnumber", "passport", "email"]),
        _record_part("c_location", 1, ["fullname", "city", "address"]),
        _record_part(
            "c_professional", 2,
            ["fullname", "company", "company_address", "company_telfnumber", "company_email", "job"],
        ),
        _record_part("c_bank", 3, ["passport", "IBAN", "salary"]),
        _record_part("c_net", 4, ["address", "IPv4"]),
    ]
)

_LOADED = "fused WHERE passport <> '' AND name <> '' AND last_name <> '' AND email <> ''"

# Steps that several oracles share, in order of dependence.
_STEPS: list[tuple[str, str]] = [
    *[(name, sql) for name, sql in VIEWS.items()],
    ("c_personal", f"""SELECT ord, passport, {_CLEAN_NAME} AS name, last_name, sex,
        {_phone('telfnumber')} AS telfnumber, email FROM fx_personal"""),
    ("c_location", """SELECT ord, fullname, replace(city, ',', '') AS city,
        replace(address, ',', '') AS address FROM fx_location"""),
    ("c_professional", f"""SELECT ord, fullname, company,
        replace(company_address, ',', '') AS company_address,
        {_phone('company_telfnumber')} AS company_telfnumber, company_email, job
        FROM fx_professional"""),
    ("c_bank", "SELECT * FROM fx_bank"),
    ("c_net", "SELECT ord, replace(address, ',', '') AS address, IPv4 FROM fx_net"),
    ("person_location", """SELECT p.ord, min(l.ord) AS location_ord
        FROM c_personal p JOIN c_location l
          ON contains(lower(l.fullname), lower(trim(p.name)))
         AND contains(lower(l.fullname), lower(trim(p.last_name)))
        WHERE p.name <> '' AND p.last_name <> '' AND l.fullname <> ''
        GROUP BY p.ord"""),
    ("matched", """SELECT p.*, l.ord AS location_ord, l.fullname, l.city, l.address,
          (SELECT min(r.ord) FROM c_professional r WHERE r.fullname = l.fullname) AS professional_ord,
          (SELECT min(b.ord) FROM c_bank b WHERE b.passport = p.passport) AS bank_ord,
          (SELECT min(n.ord) FROM c_net n WHERE n.address <> ''
             AND replace(lower(n.address), ' ', '') = replace(lower(l.address), ' ', '')) AS net_ord
        FROM c_personal p LEFT JOIN person_location f ON f.ord = p.ord
        LEFT JOIN c_location l ON l.ord = f.location_ord"""),
    ("joined", """SELECT m.ord, m.passport, m.name, m.last_name, m.sex, m.telfnumber, m.email,
          m.fullname, m.city, coalesce(n.address, m.address) AS address, r.company,
          r.company_address, r.company_telfnumber, r.company_email, r.job, b.IBAN, b.salary, n.IPv4,
          concat_ws(',', CASE WHEN m.location_ord IS NULL THEN 'location' END,
            CASE WHEN r.ord IS NULL THEN 'professional' END,
            CASE WHEN b.ord IS NULL THEN 'bank' END,
            CASE WHEN n.ord IS NULL THEN 'net' END) AS missing
        FROM matched m LEFT JOIN c_professional r ON r.ord = m.professional_ord
        LEFT JOIN c_bank b ON b.ord = m.bank_ord LEFT JOIN c_net n ON n.ord = m.net_ord"""),
    ("fused", "SELECT * EXCLUDE (missing) FROM joined WHERE missing = ''"),
    ("incomplete", "SELECT * FROM joined WHERE missing <> ''"),
    ("locations", """SELECT row_number() OVER (ORDER BY min(ord)) AS location_id, address, city
        FROM fused WHERE address <> '' AND city <> '' GROUP BY address, city"""),
    ("claims", f"SELECT *, row_number() OVER (PARTITION BY email ORDER BY ord) AS claim FROM {_LOADED}"),
    ("persons", """SELECT passport, name AS first_name, last_name, sex, telfnumber AS phone_number,
        email, location_id AS location_id_fk
        FROM claims LEFT JOIN locations USING (address, city) WHERE claim = 1"""),
    ("bank_data", """SELECT row_number() OVER (ORDER BY ord) AS bank_id, passport AS passport_fk,
        IBAN AS iban, salary FROM claims WHERE claim = 1"""),
    ("nets", """SELECT *, row_number() OVER (PARTITION BY IPv4 ORDER BY ord) AS net_claim
        FROM claims WHERE claim = 1"""),
    ("network_data", """SELECT row_number() OVER (ORDER BY ord) AS network_id,
        passport AS passport_fk, location_id AS location_id_fk, IPv4 AS ip_address
        FROM nets LEFT JOIN locations USING (address, city) WHERE net_claim = 1"""),
    ("professional_data", """SELECT row_number() OVER (ORDER BY ord) AS professional_id,
        passport AS passport_fk, company AS company_name, company_address,
        company_telfnumber AS company_phone_number, company_email, job AS job_title
        FROM claims WHERE claim = 1"""),
    ("served", """SELECT sex, professional_id, company_name, company_address, company_phone_number,
        company_email, job_title, address, city, bank_id, iban, salary, network_id, ip_address
        FROM persons p LEFT JOIN professional_data r ON r.passport_fk = p.passport
        LEFT JOIN locations l ON l.location_id = p.location_id_fk
        LEFT JOIN bank_data b ON b.passport_fk = p.passport
        LEFT JOIN network_data n ON n.passport_fk = p.passport"""),
    ("records", _RECORDS),
    ("typed", """SELECT *, CASE WHEN NOT json_valid(value) THEN NULL
          WHEN list_contains(ks, 'passport') AND list_contains(ks, 'name') THEN 'personal'
          WHEN list_contains(ks, 'fullname') AND list_contains(ks, 'city') THEN 'location'
          WHEN list_contains(ks, 'company') OR list_contains(ks, 'job') THEN 'professional'
          WHEN list_contains(ks, 'iban') THEN 'bank'
          WHEN list_contains(ks, 'ipv4') THEN 'net' ELSE 'unknown' END AS fragment_type
        FROM (SELECT *, CASE WHEN json_valid(value)
            THEN list_transform(json_keys(value), lambda k: lower(k)) END AS ks
          FROM fx_messages) m"""),
    ("decoded", """SELECT *, CASE WHEN fragment_type IS NULL THEN 'not a JSON object'
          WHEN (CASE fragment_type
            WHEN 'personal' THEN json_extract_string(value, '$.passport')
            WHEN 'location' THEN json_extract_string(value, '$.fullname')
            WHEN 'professional' THEN json_extract_string(value, '$.fullname')
            WHEN 'bank' THEN json_extract_string(value, '$.passport')
            WHEN 'net' THEN json_extract_string(value, '$.IPv4') ELSE '' END) IS NULL
          THEN 'no key' END AS reason,
          CASE WHEN fragment_type IS NOT NULL THEN array_to_string(list_transform(
            list_sort(json_keys(value)),
            lambda k: k || ':' || CAST(json_extract(value, '$."' || k || '"') AS VARCHAR)), ',')
          END AS content
        FROM typed"""),
]


def _merged(source: str, kind: str, key: str, fields: list[str]) -> str:
    """Latest present value per field, nulls included."""
    def path(f: str) -> str:
        return f"'$.\"{f.replace('company_address', 'company address')}\"'"

    def text(f: str) -> str:
        plain = f"json_extract_string(value, {path(f)})"
        if f != "sex":
            return plain
        return (
            f"CASE json_type(value, {path(f)}) WHEN 'ARRAY'"
            f" THEN json_extract_string(value, '$.sex[0]') ELSE {plain} END"
        )

    latest = ", ".join(
        f"arg_max_null({text(f)}, ord) FILTER (WHERE json_exists(value, {path(f)})) AS {f}"
        for f in fields if f != key
    )
    return f"""SELECT {text(key)} AS {key}, min(ord) AS ord, max(ord) AS last_ord, {latest}
        FROM {source} WHERE fragment_type = '{kind}' AND reason IS NULL GROUP BY {text(key)}"""


def _fold(source: str, keys: str, ts: str, order: str, columns: str) -> str:
    """Accepted rows by stepping through each key in time order."""
    on = " AND ".join(f"n.{k} IS NOT DISTINCT FROM s.{k}" for k in keys.split(", "))
    names = ", ".join(f"n.{k}" for k in keys.split(", "))
    return f"""
        numbered AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ts}, {order}) AS rn
          FROM {source}),
        steps AS (
          SELECT {keys}, rn, {ts} AS last, TRUE AS taken FROM numbered WHERE rn = 1
          UNION ALL
          SELECT {names}, n.rn,
            CASE WHEN n.{ts} >= s.last + INTERVAL 24 HOUR THEN n.{ts} ELSE s.last END,
            n.{ts} >= s.last + INTERVAL 24 HOUR
          FROM steps s JOIN numbered n ON {on} AND n.rn = s.rn + 1),
        accepted AS (SELECT {columns} FROM numbered n JOIN steps s ON {on} AND n.rn = s.rn
          WHERE s.taken)"""


def _arrivals(source: str, keys: str, ts: str, order: str, columns: str, arrival: str) -> str:
    """Accepted rows by stepping through each key in order of arrival, then time: those with no
    accepted row less than a day away, before or after."""
    on = " AND ".join(f"n.{k} IS NOT DISTINCT FROM s.{k}" for k in keys.split(", "))
    names = ", ".join(f"n.{k}" for k in keys.split(", "))
    free = f"len(list_filter(s.held, lambda x: abs(epoch_us(x) - epoch_us(n.{ts})) < 86400000000)) = 0"
    return f"""
        numbered AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {arrival}, {ts}, {order}) AS rn
          FROM {source}),
        steps AS (
          SELECT {keys}, rn, [{ts}] AS held, TRUE AS taken FROM numbered WHERE rn = 1
          UNION ALL
          SELECT {names}, n.rn, CASE WHEN {free} THEN list_append(s.held, n.{ts}) ELSE s.held END, {free}
          FROM steps s JOIN numbered n ON {on} AND n.rn = s.rn + 1),
        accepted AS (SELECT {columns} FROM numbered n JOIN steps s ON {on} AND n.rn = s.rn
          WHERE s.taken)"""


def _components(source: str, record_id: str, keys: list[str], on: str = "key, value") -> str:
    """Reachability over links from each record to the first one with the same value."""
    return f"""
        melted AS ({_melt(source, record_id, keys)}),
        firsts AS (SELECT {on}, min(id) AS root FROM melted GROUP BY {on}),
        links AS (SELECT DISTINCT id AS child, root AS parent FROM melted JOIN firsts USING ({on})
          WHERE id <> root),
        edges AS (SELECT child AS a, parent AS b FROM links UNION SELECT parent, child FROM links),
        reach AS (SELECT {record_id} AS id, {record_id} AS near FROM {source}
          UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.near),
        labels AS (SELECT id, min(near) AS component FROM reach GROUP BY id)"""


def _grouped(keys: list[str], on: str = "key, value") -> str:
    latest = ", ".join(f"arg_max({f}, record_id) AS {f}" for f in _FIELDS)
    return f"""{_components('records', 'record_id', keys, on)}
        SELECT component, count(*) AS records, {latest}
        FROM records JOIN labels ON id = record_id GROUP BY component"""


def _sql(body: str) -> str:
    """``body`` behind the shared steps; it may begin with steps of its own."""
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in _STEPS)
    own = not body.lstrip().upper().startswith("SELECT")
    return f"WITH RECURSIVE {steps}{',' if own else ''}\n{body}"


_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

_FLAT = ", ".join(
    f'{f} AS "{prefix}{f.replace("company_address", "company address")}"'
    for prefix, fields in [
        ("personal_", ["name", "last_name", "sex", "telfnumber", "passport", "email"]),
        ("location_", ["fullname", "address", "city", "IPv4"]),
        ("professional_", ["fullname", "company", "company_address", "company_telfnumber",
                           "company_email", "job"]),
        ("bank_", ["passport", "IBAN", "salary"]),
    ]
    for f in fields
)

_REJECTED = """SELECT 'persons' AS target, ord, passport, 'duplicate email' AS violated
      FROM claims WHERE claim > 1
    UNION ALL SELECT t.target, ord, passport, 'unknown person' FROM claims,
      (VALUES ('bank_data'), ('network_data'), ('professional_data')) t(target) WHERE claim > 1
    UNION ALL SELECT 'network_data', ord, passport, 'duplicate ip_address'
      FROM nets WHERE net_claim > 1"""

# Persons stored by an earlier load: other passports for the first of each pair of customers
# and a mail address that a new person wants as well.
STORED_PERSONS = """SELECT 'P' || lpad(CAST(c_custkey * 2 AS STRING), 9, '0') AS passport,
      'Old' AS first_name, 'Ln' || CAST(c_custkey AS STRING) AS last_name,
      CAST(NULL AS STRING) AS sex, CAST(NULL AS STRING) AS phone_number,
      CASE WHEN c_custkey % 3 = 0 THEN 'u' || CAST(c_custkey AS STRING) || '@mail.example'
        ELSE 'old' || CAST(c_custkey AS STRING) || '@mail.example' END AS email,
      CAST(NULL AS BIGINT) AS location_id_fk
    FROM customer"""

_WINDOWS = """panes AS (SELECT event_type AS metric,
        CAST(floor(epoch(ts) / 10) AS BIGINT) AS pane,
        sum(CAST(value AS DECIMAL(28, 6))) AS total, count(value) AS observations
      FROM events GROUP BY 1, 2),
    spread AS (SELECT metric, unnest(range(pane + 1, pane + 7)) AS last_pane, total, observations
      FROM panes),
    windows AS (SELECT metric, make_timestamp(last_pane * 10000000) AS window_end,
        CAST(sum(total) AS DECIMAL(28, 6)) AS total, CAST(sum(observations) AS BIGINT) AS observations
      FROM spread GROUP BY 1, 2)"""

_WINDOW_ROWS = """SELECT metric, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
      CAST(total AS DOUBLE) AS total, observations,
      round(CAST(total AS DOUBLE) / observations, 6) AS mean FROM windows"""


# Queries that come to the result of another one step by step.
_SAME = {
    "ttl_dedup_split_keys": "ttl_dedup_null_keys",
    "ingest_one_pass": "ingest_metrics",
    "grown_name_in_fullname": "name_in_fullname",
    "grown_people": "group_records_all_keys",
    "grown_people_by_value": "group_records_by_value",
}


def oracles() -> dict[str, str]:
    key_melt = _melt("incomplete", "ord", _NAME_KEYS)
    person_melt = _melt("persons", "passport", ["passport", "email", "last_name"])
    matches = f"""mine AS ({key_melt}), theirs AS ({person_melt})"""
    json_parts = " || ".join(
        f"""coalesce(',"{c}":' || {"'" + '"' + "' || " + c + " || '" + '"' + "'" if text else f"CAST({c} AS VARCHAR)"}, '')"""
        for c, text in [
            ("sex", True), ("professional_id", False), ("company_name", True),
            ("company_address", True), ("company_phone_number", True), ("company_email", True),
            ("job_title", True), ("address", True), ("city", True), ("bank_id", False),
            ("iban", True), ("salary", True), ("network_id", False), ("ip_address", True),
        ]
    )
    personal_fields = ["name", "last_name", "sex", "telfnumber", "passport", "email"]
    event_columns = (
        "n.event_id, n.user_id, n.event_type, strftime(n.ts, '%Y-%m-%d %H:%M:%S') AS accepted_at"
    )
    events_fold = _fold("events", "user_id, event_type", "ts", "event_id", event_columns)
    fragment_fields = {
        "personal": ("passport", personal_fields),
        "location": ("fullname", ["fullname", "city", "address"]),
        "professional": ("fullname", [
            "fullname", "company", "company_address", "company_telfnumber", "company_email", "job"]),
        "bank": ("passport", ["passport", "IBAN", "salary"]),
        "net": ("IPv4", ["address", "IPv4"]),
    }
    bodies = {
        "fuse_persons": "SELECT * FROM fused",
        "clean_personal": "SELECT * FROM c_personal",
        "clean_location": "SELECT * FROM c_location",
        "clean_professional": "SELECT * FROM c_professional",
        "route_fragments": "SELECT ord, fragment_type, reason FROM decoded",
        "fingerprint_groups": """SELECT min(ord) AS first_ord, count(*) AS messages FROM decoded
            WHERE content IS NOT NULL GROUP BY content""",
        "sql_functions": """SELECT p.ord, p.name, p.telfnumber, l.address,
              coalesce(p.name <> '' AND p.last_name <> '' AND contains(lower(l.fullname), lower(trim(p.name)))
                AND contains(lower(l.fullname), lower(trim(p.last_name))), false) AS named,
              coalesce(l.address <> '', false) AS same_address
            FROM c_personal p JOIN c_location l ON p.ord = l.ord""",
        "flatten_prefix": f"SELECT record_id, {_FLAT} FROM records",
        "name_in_fullname": """SELECT ord, location_ord FROM person_location""",
        "incomplete_persons": "SELECT * FROM incomplete",
        "completeness_totals": """SELECT count(*) AS persons, count(*) FILTER (WHERE missing = '') AS complete,
            count(*) FILTER (WHERE missing <> '') AS incomplete,
            count(*) FILTER (WHERE contains(missing, 'location')) AS missing_location,
            count(*) FILTER (WHERE contains(missing, 'professional')) AS missing_professional,
            count(*) FILTER (WHERE contains(missing, 'bank')) AS missing_bank,
            count(*) FILTER (WHERE contains(missing, 'net')) AS missing_net FROM joined""",
        "dim_locations": "SELECT * FROM locations",
        "persons_load": "SELECT * FROM persons",
        "persons_rejected": _REJECTED,
        "broken_rows_rejected": """faults AS (SELECT *, ord % 50 AS fault FROM fused),
            checked AS (SELECT *, CASE fault WHEN 1 THEN 'long last_name' WHEN 2 THEN 'missing email' END AS rule FROM faults),
            claimed AS (SELECT *, CASE WHEN rule IS NULL THEN row_number() OVER (
              PARTITION BY email, rule IS NULL ORDER BY ord) END AS claim_no FROM checked),
            judged AS (SELECT *, coalesce(rule, CASE WHEN claim_no > 1 THEN 'duplicate email' END) AS person FROM claimed),
            nets_in AS (SELECT *, CASE WHEN fault = 3 THEN 'invalid ip_address' WHEN person IS NOT NULL THEN 'unknown person'
              END AS net_rule FROM judged),
            nets_no AS (SELECT *, CASE WHEN net_rule IS NULL THEN row_number() OVER (
              PARTITION BY IPv4, net_rule IS NULL ORDER BY ord) END AS net_no FROM nets_in),
            found AS (
              SELECT 'locations' AS target, ord, passport, CASE fault WHEN 5 THEN 'long address' END AS violated FROM judged
              UNION ALL SELECT 'persons', ord, passport, person FROM judged
              UNION ALL SELECT 'bank_data', ord, passport, CASE WHEN fault = 4 THEN 'long iban'
                WHEN person IS NOT NULL THEN 'unknown person' END FROM judged
              UNION ALL SELECT 'network_data', ord, passport,
                coalesce(net_rule, CASE WHEN net_no > 1 THEN 'duplicate ip_address' END) FROM nets_no
              UNION ALL SELECT 'professional_data', ord, passport, CASE WHEN fault = 6 THEN 'missing company_name'
                WHEN person IS NOT NULL THEN 'unknown person' END FROM judged)
            SELECT * FROM found WHERE violated IS NOT NULL""",
        "bank_load": "SELECT * FROM bank_data",
        "network_load": "SELECT * FROM network_data",
        "professional_load": "SELECT * FROM professional_data",
        "upsert_persons": f"""stored AS ({STORED_PERSONS}),
            free AS (SELECT c.* FROM fused c WHERE NOT EXISTS (
              SELECT 1 FROM stored s WHERE s.email = c.email AND s.passport <> c.passport)),
            fresh AS (SELECT *, row_number() OVER (PARTITION BY email ORDER BY ord) AS claim FROM free)
            SELECT passport, name AS first_name, last_name, sex, telfnumber AS phone_number, email,
              location_id AS location_id_fk
            FROM fresh LEFT JOIN locations USING (address, city) WHERE claim = 1
            UNION ALL SELECT * FROM stored WHERE passport NOT IN
              (SELECT passport FROM fresh WHERE claim = 1)""",
        "facet_cities": "SELECT DISTINCT city FROM locations WHERE city <> ''",
        "facet_jobs": "SELECT DISTINCT job_title FROM professional_data WHERE job_title <> ''",
        "persons_by_city_job": """SELECT * FROM served
            WHERE starts_with(city, 'NATION_1') AND starts_with(job_title, 'MACH')""",
        "persons_by_city_all": "SELECT * FROM served WHERE starts_with(city, 'NATION_2')",
        "persons_json": f"SELECT '{{' || substr({json_parts}, 2) || '}}' AS json FROM served",
        "any_key_matches": f"""{matches} SELECT m.id AS ord, m.key, m.value, count(*) AS matches,
            min(t.id) AS first_match FROM mine m JOIN theirs t USING (key, value)
            GROUP BY m.id, m.key, m.value""",
        "any_key_matched_persons": f"""{matches} SELECT t.id AS passport, t.key, t.value,
            count(*) AS matches, min(m.id) AS first_match FROM theirs t JOIN mine m USING (key, value)
            GROUP BY t.id, t.key, t.value""",
        "any_key_links": f"""{_components('incomplete', 'ord', _NAME_KEYS)}
            SELECT child, parent FROM links""",
        "components_incomplete": f"""{_components('incomplete', 'ord', _NAME_KEYS)},
            sizes AS (SELECT component, count(*) AS records FROM labels GROUP BY component)
            SELECT component, id AS ord, records FROM labels JOIN sizes USING (component)
            WHERE records > 1""",
        "group_records": _grouped(_STRONG_KEYS),
        "group_records_by_value": _grouped(_NAME_KEYS, "value"),
        "group_records_all_keys": _grouped(_NAME_KEYS),
        "lookup_passport": """askers AS (SELECT ord, fullname, address, passport FROM joined)
            SELECT a.ord, (SELECT arg_min(b.passport, b.ord) FROM askers b WHERE b.ord <> a.ord
              AND b.passport <> '' AND ((a.fullname <> '' AND b.fullname = a.fullname)
                OR (a.address <> '' AND b.address = a.address))) AS passport
            FROM askers a""",
        "lookup_location_id": """SELECT j.ord, l.location_id FROM joined j
            LEFT JOIN locations l ON l.address = j.address AND l.city = j.city
              AND j.address <> '' AND j.city <> ''""",
        "lookup_person_priority": f"""asked AS ({_melt('records', 'record_id', _NAME_KEYS)}),
            known AS (SELECT value, max(id) AS person
              FROM ({_melt('c_personal', 'ord', _NAME_KEYS[:2] + _NAME_KEYS[3:6])}) k GROUP BY value)
            SELECT id AS record_id, arg_min(person, pos) AS person, arg_min(key, pos) AS found_by
            FROM asked JOIN known USING (value) GROUP BY id""",
        "ttl_dedup_events": f"{events_fold} SELECT * FROM accepted",
        "ttl_dedup_null_keys": f"""holed AS (SELECT * REPLACE (
              CASE WHEN event_id % 3 > 0 THEN user_id END AS user_id) FROM events),
            {_fold("holed", "user_id, event_type", "ts", "event_id", event_columns)} SELECT * FROM accepted""",
        "stream_ttl_dedup": _arrivals(
            "events", "user_id, event_type", "ts", "event_id", event_columns, "event_id % 3"
        ) + " SELECT * FROM accepted",
        "raw_upsert_merge": _merged("decoded", "personal", "passport", personal_fields),
        "raw_upsert_bank": _merged("decoded", "bank", "passport", ["passport", "IBAN", "salary"]),
        "raw_upsert_professional": _merged(
            "decoded", "professional", "fullname",
            ["fullname", "company", "company_address", "company_telfnumber", "company_email", "job"],
        ),
        "unknown_dedup": """SELECT min(ord) AS ord, arg_min(value, ord) AS value FROM decoded
            WHERE fragment_type = 'unknown' GROUP BY content""",
        "quarantine": "SELECT ord, value, reason FROM decoded WHERE reason IS NOT NULL",
        "raw_upsert_location": _merged("decoded", "location", *fragment_fields["location"]),
        "raw_upsert_net": _merged("decoded", "net", *fragment_fields["net"]),
        "stream_raw_upsert": f"""typed_ok AS (SELECT * FROM decoded
              WHERE reason IS NULL AND fragment_type <> 'unknown'),
            {_fold('typed_ok', 'content', 'ingest_ts', 'ord', 'n.ord, n.value, n.fragment_type, n.reason')}
            """ + " UNION ALL BY NAME ".join(
                f"SELECT '{t}' AS fragment_type, * FROM ({_merged('accepted', t, *f)})"
                for t, f in fragment_fields.items()
            ),
        "folded_collections": "SELECT * FROM (" + " UNION ALL BY NAME ".join(
            [f"SELECT '{t}' AS fragment_type, * FROM ({_merged('decoded', t, *f)})" for t, f in fragment_fields.items()]
            + ["SELECT 'unknown' AS fragment_type, min(ord) AS ord, arg_min(value, ord) AS value FROM decoded"
               " WHERE fragment_type = 'unknown' GROUP BY content"]
        ) + ")",
        "stored_warehouse": "SELECT * FROM (" + " UNION ALL BY NAME ".join(
            f"SELECT '{t}' AS stored_in, * FROM {t}"
            for t in ("locations", "persons", "bank_data", "network_data", "professional_data")
        ) + ")",
        "ingest_metrics": _arrivals(
            "(SELECT * FROM decoded WHERE reason IS NULL)", "content", "ingest_ts", "ord",
            "n.fragment_type", "CASE WHEN ord >= 2000000000 THEN 0 WHEN ord >= 1000000000 THEN 1 ELSE 2 END",
        ) + """ SELECT 'stored ' || fragment_type AS metric, CAST(count(*) AS DOUBLE) AS total
              FROM accepted GROUP BY 1
            UNION ALL SELECT coalesce(reason, 'received ' || fragment_type), CAST(count(*) AS DOUBLE)
              FROM decoded GROUP BY 1""",
        "rolling_mean_1m": f"{_WINDOWS} {_WINDOW_ROWS}",
        "stream_rolling_mean": f"{_WINDOWS} {_WINDOW_ROWS}",
        "duration_histogram": " UNION ALL ".join(
            [
                f"SELECT event_type, '{b}' AS le, count(*) FILTER (WHERE value <= {b}) AS bucket"
                " FROM events GROUP BY event_type"
                for b in _BUCKETS
            ]
            + ["SELECT event_type, '+Inf' AS le, count(value) AS bucket FROM events GROUP BY event_type"]
        ),
        "mean_message_size": """SELECT count(value) AS messages,
            CAST(sum(octet_length(encode(value))) AS BIGINT) AS total_bytes,
            round(avg(octet_length(encode(value))), 6) AS mean_bytes FROM fx_messages""",
        "step_summary": """SELECT event_type, count(value) AS observations,
            CAST(sum(CAST(value AS DECIMAL(28, 6))) AS DOUBLE) AS total FROM events GROUP BY event_type""",
        "step_counters": """SELECT coalesce(fragment_type, 'none') AS step, count(*) AS total,
            count(*) FILTER (WHERE reason IS NOT NULL) AS errors FROM decoded GROUP BY 1""",
        "last_status": """SELECT user_id, arg_max(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END,
            {'ts': ts, 'event_id': event_id}) AS status FROM events GROUP BY user_id""",
        "roundtrip_json": "SELECT * FROM incomplete",
        "roundtrip_json_array": "SELECT * FROM incomplete",
        "roundtrip_csv": f"""{_components('records', 'record_id', _STRONG_KEYS)},
            people AS (SELECT {', '.join(f'arg_max({f}, record_id) AS {f}' for f in _FIELDS)}
              FROM records JOIN labels ON id = record_id GROUP BY component)
            SELECT {_FLAT} FROM people""",
        "roundtrip_raw": """SELECT fragment_type, count(*) AS fragments FROM decoded
            WHERE reason IS NULL GROUP BY fragment_type""",
        "roundtrip_warehouse": "SELECT * FROM persons",
        "audit_log": """SELECT strftime(ts, '%Y-%m-%d') AS day,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
            CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
            'step' AS source, event_type || ' by ' || CAST(user_id AS VARCHAR) AS message FROM events""",
    }
    bodies |= {name: bodies[other] for name, other in _SAME.items()}
    return {name: _sql(body) for name, body in bodies.items()}
