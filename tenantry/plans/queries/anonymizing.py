"""Surrogates, hashes and tokens for the people, places and addresses of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.functions import surrogates as s
from tenantry.model import AnonymizationRule, Tables
from tenantry.operators import anonymize
from tenantry.operators.anonymize import PII_PATTERNS, Anonymizer
from tenantry.plans.bindings import AS_OF, SALT, reader
from tenantry.plans.default_rules import ANONYMIZATION_RULES

RULES = (
    *ANONYMIZATION_RULES,
    AnonymizationRule("badges", "^badge$", "surrogate", "badge"),
    AnonymizationRule("accounts", "^account$", "format"),
    AnonymizationRule("mailboxes", "^mailbox$", "domain"),
)


def _default(**options) -> Anonymizer:
    return Anonymizer(RULES, SALT, AS_OF, **options)


def _made(kind: str, rule: str, value: Column) -> Column:
    return s.surrogate(kind, rule, value, SALT, AS_OF)


def anon_hash(spark: SparkSession, folder: str) -> DataFrame:
    orders = reader(spark, folder)("orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        "o_orderkey",
        s.salted_hash(F.col("o_custkey"), SALT).alias("customer_hash"),
        s.salted_hash(F.col("o_orderpriority"), SALT).alias("priority_hash"),
        s.salted_hash(day, SALT, "unknown").alias("day_hash"),
    )


def anon_email(spark: SparkSession, folder: str) -> DataFrame:
    orders = reader(spark, folder)("orders")
    return orders.select("o_orderkey", _made("email", "email_addresses", F.col("o_custkey")).alias("email"))


def anon_names(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("c_name")
    return reader(spark, folder)("customer").select(
        "c_custkey",
        _made("first_name", "first_names", name).alias("first_name"),
        _made("last_name", "last_names", name).alias("last_name"),
        _made("name", "full_names", name).alias("full_name"),
        _made("user_name", "usernames", name).alias("user_name"),
    )


def anon_contact(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("c_name")
    return reader(spark, folder)("customer").select(
        "c_custkey",
        _made("phone_number", "phone_numbers", name).alias("phone"),
        _made("street_address", "street_addresses", name).alias("street"),
        _made("city", "cities", name).alias("city"),
        _made("zipcode", "zip_codes", name).alias("zip_code"),
    )


def anon_birth_date(spark: SparkSession, folder: str) -> DataFrame:
    born = s.surrogate("date_of_birth", "birth_dates", F.col("o_orderkey"), SALT, AS_OF, minimum_age=5, maximum_age=85)
    return reader(spark, folder)("orders").select("o_orderkey", F.date_format(born, "yyyy-MM-dd").alias("birth_date"))


def anon_network(spark: SparkSession, folder: str) -> DataFrame:
    events = reader(spark, folder)("events")
    return events.select("event_id", _made("ipv4", "ip_addresses", F.col("user_id")).alias("ip_address"))


def anon_url(spark: SparkSession, folder: str) -> DataFrame:
    return reader(spark, folder)("pages").select("page_id", _made("url", "urls", F.col("url")).alias("url"))


def anon_format(spark: SparkSession, folder: str) -> DataFrame:
    """Priorities and names of orders and customers, put together to a long text."""
    text = F.concat_ws(" / ", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad("o_custkey", 18, "0"))
    return reader(spark, folder)("orders").select("o_orderkey", s.format_preserving("accounts", text, SALT).alias("account"))


def anon_domain(spark: SparkSession, folder: str) -> DataFrame:
    address = F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com"))
    address = F.when(F.col("c_acctbal") < 0, F.lower("c_name")).otherwise(address)
    made = s.domain_preserving_email("mailboxes", address, SALT)
    return reader(spark, folder)("customer").select("c_custkey", made.alias("mailbox"))


def people(spark: SparkSession, folder: str) -> Tables:
    """Customers, suppliers and orders under column names that the rules know."""
    t = reader(spark, folder)
    name, key = F.col("c_name"), F.col("c_custkey")
    customers = t("customer").select(
        key.alias("customer_id"),
        F.concat(F.lower(name), F.lit("@corp.example.com")).alias("user_email"),
        F.lpad(key.cast("string"), 9, "0").alias("ssn"),
        name.alias("first_name"),
        name.alias("lname"),
        name.alias("full_name"),
        key.cast("string").alias("phone"),
        name.alias("address_line1"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("state"),
        key.alias("zip_code"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_nationkey")).alias("dob"),
        F.lower(name).alias("username"),
        name.alias("pwd_hash"),
        key.cast("string").alias("ip_address"),
        name.alias("homepage_url"),
        F.when(F.col("c_acctbal") >= 0, name).alias("last_login_ip"),
        name.alias("schoolname"),
        key.alias("hotel_id"),
        F.when(F.col("c_acctbal") < 0, name).alias("badge"),
        name.alias("name"),
    )
    suppliers = t("supplier").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("full_name"), F.col("s_nationkey").alias("state")
    )
    orders = t("orders").select(
        F.col("o_orderkey").alias("order_id"), F.concat(F.lit("Customer#"), F.lpad("o_custkey", 9, "0")).alias("full_name")
    )
    return {"customers": customers, "suppliers": suppliers, "orders": orders}


def anon_table(spark: SparkSession, folder: str) -> DataFrame:
    made = _default().table(people(spark, folder)["customers"])
    return made.withColumn("dob", F.date_format("dob", "yyyy-MM-dd"))


def anon_report(spark: SparkSession, folder: str) -> DataFrame:
    return anonymize.report(_default().dataset(people(spark, folder)), RULES)


def anon_tokenize(spark: SparkSession, folder: str) -> DataFrame:
    orders = reader(spark, folder)("orders").select("o_orderkey", "o_custkey")
    return anonymize.tokenize(orders, "o_custkey", anonymize.build_tokens(orders.select("o_custkey")))


def anon_tokenize_more(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of customers first; suppliers get the numbers after them."""
    t = reader(spark, folder)
    stored = anonymize.build_tokens(t("customer").select("c_name"))
    both = t("customer").select("c_name").union(t("supplier").select("s_name"))
    return anonymize.build_tokens(both, stored)


def detokenize(spark: SparkSession, folder: str) -> DataFrame:
    orders = reader(spark, folder)("orders").select("o_orderkey", "o_custkey")
    tokens = anonymize.build_tokens(orders.select("o_custkey"))
    return anonymize.detokenize(anonymize.tokenize(orders, "o_custkey", tokens), "o_custkey", tokens)


def consistency_map(spark: SparkSession, folder: str) -> DataFrame:
    data = people(spark, folder)
    return anonymize.consistency_map({n: df.select("full_name") for n, df in data.items()}, _default())


def stored_map(spark: SparkSession, folder: str) -> DataFrame:
    """A map made under an earlier salt wins over new surrogates."""
    data = {"suppliers": people(spark, folder)["suppliers"]}
    earlier = anonymize.consistency_map(data, Anonymizer(RULES, "earlier", AS_OF))
    everyone = people(spark, folder)
    both = everyone["suppliers"].select("full_name").unionByName(everyone["orders"].select("full_name"))
    return _default(stored=earlier).table(both).groupBy("full_name").agg(F.count(F.lit(1)).alias("rows"))


def merged_map(spark: SparkSession, folder: str) -> DataFrame:
    data = {n: df.select("full_name") for n, df in people(spark, folder).items()}
    stored = anonymize.consistency_map({"suppliers": data["suppliers"]}, Anonymizer(RULES, "earlier", AS_OF))
    return anonymize.merge_maps(stored, anonymize.consistency_map(data, _default()))


def consistency_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of customers stand for originals that got a surrogate by customer, which is inconsistent."""
    customers = reader(spark, folder)("customer")
    bad = customers.select(
        F.lit("segments").alias("rule"),
        F.col("c_mktsegment").alias("original"),
        _made("city", "cities", F.col("c_custkey")).alias("surrogate"),
    )
    good = customers.select(
        F.lit("names").alias("rule"), F.col("c_name").alias("original"), _made("city", "cities", F.col("c_name")).alias("surrogate")
    )
    return anonymize.inconsistent_values(bad.unionByName(good))


def _half_done(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in debt were left as they are."""
    t = reader(spark, folder)
    debt = F.col("c_acctbal") < 0
    raw = F.concat(F.lower("c_name"), F.lit("@corp.example.com"))
    return t("customer").select(
        F.when(debt, raw).otherwise(_made("email", "email_addresses", raw)).alias("email"),
        F.when(debt, F.substring("c_name", 1, 2)).otherwise(_made("first_name", "first_names", F.col("c_name"))).alias("first_name"),
        F.when(debt, F.col("c_name")).otherwise(_made("name", "full_names", F.col("c_name"))).alias("full_name"),
        F.col("c_mktsegment").alias("city"),
    )


def leak_scan(spark: SparkSession, folder: str) -> DataFrame:
    return anonymize.suspicious_values(_half_done(spark, folder), RULES)


def overlap_scan(spark: SparkSession, folder: str) -> DataFrame:
    original = people(spark, folder)["customers"].select(F.col("user_email").alias("email"), "full_name", "city")
    after = _half_done(spark, folder).select("email", "full_name", "city")
    return anonymize.leaked_values({"customers": original}, {"customers": after}, RULES)


def pii_content_scan(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    return (
        anonymize.pii_in_text(t("documents"), ["text"])
        .unionByName(anonymize.pii_in_text(t("pages"), ["html"]))
        .unionByName(anonymize.pii_in_text(t("conversations").withColumnRenamed("text", "turn_text"), ["turn_text"]))
    )


def pii_redact(spark: SparkSession, folder: str) -> DataFrame:
    return reader(spark, folder)("documents").select("doc_id", anonymize.redact(F.col("text")).alias("text"))


def clean_range(spark: SparkSession, folder: str) -> DataFrame:
    size = s.implausible_to_null(F.col("p_size"), empty=1, highest=40)
    return reader(spark, folder)("part").select("p_partkey", size.alias("p_size"))


# --- the same in SQL ------------------------------------------------------------


def _key(rule: str, value: str, salt: str = SALT) -> str:
    return f"sha256('{rule}:' || CAST({value} AS VARCHAR) || ':{salt}')"


def _n(key: str, part: int) -> str:
    return f"CAST('0x' || substr({key}, {1 + 8 * part}, 8) AS BIGINT)"


def _pick(words, number: str) -> str:
    return f"([{', '.join(repr(w) for w in words)}])[{number} % {len(words)} + 1]"


def _first(key: str, part: int = 0) -> str:
    return f"{_pick(s.FIRST_HEADS, _n(key, part))} || {_pick(s.FIRST_TAILS, _n(key, part + 1))}"


def _last(key: str, part: int = 0) -> str:
    return f"{_pick(s.LAST_HEADS, _n(key, part))} || {_pick(s.LAST_TAILS, _n(key, part + 1))}"


def _pad(number: str, width: int) -> str:
    return f"lpad(CAST({number} % {10**width} AS VARCHAR), {width}, '0')"


def made_sql(kind: str, rule: str, value: str, salt: str = SALT) -> str:
    k = _key(rule, value, salt)
    latest, earliest = f"(DATE '{AS_OF}' - INTERVAL 60 MONTH)", f"(DATE '{AS_OF}' - INTERVAL 1032 MONTH)"
    return {
        "email": f"'u' || substr({k}, 1, 12) || '@mail.example.org'",
        "first_name": _first(k),
        "last_name": _last(k),
        "name": f"{_first(k)} || ' ' || {_last(k, 2)}",
        "phone_number": f"({_n(k, 0)} % 800 + 200) || '-' || {_pad(_n(k, 1), 3)} || '-' || {_pad(_n(k, 2), 4)}",
        "street_address": f"({_n(k, 0)} % 9999 + 1) || ' ' || {_pick(s.STREETS, _n(k, 1))} || ' ' || {_pick(s.STREET_KINDS, _n(k, 2))}",
        "city": f"{_pick(s.CITY_HEADS, _n(k, 0))} || {_pick(s.CITY_TAILS, _n(k, 1))}",
        "zipcode": _pad(_n(k, 0), 5),
        "date_of_birth": f"strftime({latest} - to_days(CAST({_n(k, 0)} % date_diff('day', {earliest}, {latest}) AS INTEGER)), '%Y-%m-%d')",
        "user_name": f"lower({_first(k)}) || substr({k}, 33, 8)",
        "ipv4": " || '.' || ".join(f"({_n(k, i)} % 256)" for i in range(4)),
        "url": f"'https://' || substr({k}, 1, 12) || '.example.org/'",
    }[kind]


_PEOPLE = """
people AS (
  SELECT c_custkey AS customer_id, lower(c_name) || '@corp.example.com' AS user_email, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn,
    c_name, CAST(c_custkey AS VARCHAR) AS k, c_mktsegment, c_nationkey, c_acctbal,
    CAST(DATE '1990-01-01' + to_days(c_nationkey) AS DATE) AS dob FROM customer
)
"""
_TOKENS = "t AS (SELECT v, 'TOKEN_' || lpad(CAST(row_number() OVER (ORDER BY v) AS VARCHAR), 8, '0') AS token FROM (SELECT DISTINCT {} AS v FROM {}))"
_FULL_NAMES = """
names AS (SELECT c_name AS v FROM customer UNION SELECT s_name FROM supplier
  UNION SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') FROM orders)
"""
_RAW = "lower(c_name) || '@corp.example.com'"


def _scan_sql(column: str, table: str, text: str) -> str:
    parts = []
    for kind, pattern in PII_PATTERNS.items():
        hits = f"len(regexp_extract_all({text}, '{pattern}'))"
        parts.append(
            f"""SELECT '{column}' AS column_name, '{kind}' AS kind, count(*) FILTER (WHERE {hits} > 0) AS "rows",
            CAST(coalesce(sum({hits}), 0) AS BIGINT) AS hits FROM {table}"""
        )
    return " UNION ALL ".join(parts)


def _redacted(text: str) -> str:
    for kind, pattern in PII_PATTERNS.items():
        text = f"regexp_replace({text}, '{pattern}', '[{kind.upper()}]', 'g')"
    return text


def _report_sql() -> str:
    customers = {
        "email_addresses": ("user_email",), "ssn": ("ssn",), "first_names": ("first_name",), "last_names": ("lname", "schoolname"),
        "full_names": ("full_name",), "phone_numbers": ("phone", "hotel_id"), "street_addresses": ("address_line1",), "cities": ("city",),
        "states": ("state",), "zip_codes": ("zip_code",), "birth_dates": ("dob",), "entity_ids": ("customer_id",), "usernames": ("username", "last_login_ip"),
        "passwords": ("pwd_hash",), "ip_addresses": ("ip_address",), "urls": ("homepage_url",), "badges": ("badge",),
    }
    present = {"last_login_ip": "count(*) FILTER (WHERE c_acctbal >= 0)", "pwd_hash": "0", "badge": "count(*) FILTER (WHERE c_acctbal < 0)"}
    parts = [
        f"""SELECT 'customers' AS table_name, '{rule}' AS rule, count(*) AS "rows", 21 AS columns, {len(columns)} AS fields,
        {' + '.join(present.get(c, 'count(*)') for c in columns)} AS "values" FROM customer"""
        for rule, columns in customers.items()
    ]
    parts += [
        f"SELECT 'suppliers', '{rule}', count(*), 3, 1, count(*) FROM supplier" for rule in ("entity_ids", "full_names", "states")
    ]
    parts += [f"SELECT 'orders', '{rule}', count(*), 2, 1, count(*) FROM orders" for rule in ("entity_ids", "full_names")]
    return " UNION ALL ".join(parts)


_FORMAT_TEXT = "o_orderpriority || ' / ' || strftime(o_orderdate, '%Y-%m-%d') || ' / ' || lpad(CAST(o_custkey AS VARCHAR), 18, '0')"
_ADDRESS = "CASE WHEN c_acctbal < 0 THEN lower(c_name) ELSE lower(c_name) || '@' || lower(c_mktsegment) || '.example.com' END"

QUERIES = {
    "anon_hash": anon_hash,
    "anon_email": anon_email,
    "anon_names": anon_names,
    "anon_contact": anon_contact,
    "anon_birth_date": anon_birth_date,
    "anon_network": anon_network,
    "anon_url": anon_url,
    "anon_format": anon_format,
    "anon_domain": anon_domain,
    "anon_table": anon_table,
    "anon_report": anon_report,
    "anon_tokenize": anon_tokenize,
    "anon_tokenize_more": anon_tokenize_more,
    "detokenize": detokenize,
    "consistency_map": consistency_map,
    "stored_map": stored_map,
    "merged_map": merged_map,
    "consistency_audit": consistency_audit,
    "leak_scan": leak_scan,
    "overlap_scan": overlap_scan,
    "pii_content_scan": pii_content_scan,
    "pii_redact": pii_redact,
    "clean_range": clean_range,
}

SQL = {
    "anon_hash": f"""
        SELECT o_orderkey, substr(sha256(o_custkey || '{SALT}'), 1, 16) AS customer_hash,
          substr(sha256(o_orderpriority || '{SALT}'), 1, 16) AS priority_hash,
          substr(sha256(strftime(o_orderdate, '%Y-%m-%d') || '{SALT}'), 1, 16) AS day_hash FROM orders
    """,
    "anon_email": f"SELECT o_orderkey, {made_sql('email', 'email_addresses', 'o_custkey')} AS email FROM orders",
    "anon_names": f"""
        SELECT c_custkey, {made_sql('first_name', 'first_names', 'c_name')} AS first_name, {made_sql('last_name', 'last_names', 'c_name')} AS last_name,
          {made_sql('name', 'full_names', 'c_name')} AS full_name, {made_sql('user_name', 'usernames', 'c_name')} AS user_name FROM customer
    """,
    "anon_contact": f"""
        SELECT c_custkey, {made_sql('phone_number', 'phone_numbers', 'c_name')} AS phone, {made_sql('street_address', 'street_addresses', 'c_name')} AS street,
          {made_sql('city', 'cities', 'c_name')} AS city, {made_sql('zipcode', 'zip_codes', 'c_name')} AS zip_code FROM customer
    """,
    "anon_birth_date": f"SELECT o_orderkey, {made_sql('date_of_birth', 'birth_dates', 'o_orderkey')} AS birth_date FROM orders",
    "anon_network": f"SELECT event_id, {made_sql('ipv4', 'ip_addresses', 'user_id')} AS ip_address FROM events",
    "anon_url": f"SELECT page_id, {made_sql('url', 'urls', 'url')} AS url FROM pages",
    "anon_format": f"""
        WITH x AS (SELECT o_orderkey, {_FORMAT_TEXT} AS v FROM orders),
        y AS (SELECT o_orderkey, v, array_to_string([sha256('accounts:' || v || ':{SALT}:' || b) FOR b IN range(0, (length(v) - 1) // 32 + 1)], '') AS key FROM x)
        SELECT o_orderkey, array_to_string(
          [CASE WHEN substr(v, CAST(i AS INTEGER), 1) BETWEEN '0' AND '9' THEN CAST(CAST('0x' || substr(key, CAST(2 * i - 1 AS INTEGER), 2) AS INTEGER) % 10 AS VARCHAR)
                WHEN substr(v, CAST(i AS INTEGER), 1) BETWEEN 'a' AND 'z' THEN chr(CAST('0x' || substr(key, CAST(2 * i - 1 AS INTEGER), 2) AS INTEGER) % 26 + 97)
                WHEN substr(v, CAST(i AS INTEGER), 1) BETWEEN 'A' AND 'Z' THEN chr(CAST('0x' || substr(key, CAST(2 * i - 1 AS INTEGER), 2) AS INTEGER) % 26 + 65)
                ELSE substr(v, CAST(i AS INTEGER), 1) END FOR i IN range(1, length(v) + 1)], '') AS account FROM y
    """,
    "anon_domain": f"""
        WITH x AS (SELECT c_custkey, {_ADDRESS} AS v FROM customer)
        SELECT c_custkey, 'u' || substr({_key('mailboxes', 'v')}, 1, 12) || '@' ||
          CASE WHEN contains(v, '@') THEN split_part(v, '@', -1) ELSE 'mail.example.org' END AS mailbox FROM x
    """,
    "anon_table": f"""
        WITH {_PEOPLE} SELECT customer_id, {made_sql('email', 'email_addresses', 'user_email')} AS user_email,
          substr(sha256(ssn || '{SALT}'), 1, 16) AS ssn, {made_sql('first_name', 'first_names', 'c_name')} AS first_name,
          {made_sql('last_name', 'last_names', 'c_name')} AS lname, {made_sql('name', 'full_names', 'c_name')} AS full_name,
          {made_sql('phone_number', 'phone_numbers', 'k')} AS phone, {made_sql('street_address', 'street_addresses', 'c_name')} AS address_line1,
          {made_sql('city', 'cities', 'c_mktsegment')} AS city, c_nationkey AS state, {made_sql('zipcode', 'zip_codes', 'k')} AS zip_code,
          {made_sql('date_of_birth', 'birth_dates', 'dob')} AS dob, {made_sql('user_name', 'usernames', 'lower(c_name)')} AS username,
          CAST(NULL AS VARCHAR) AS pwd_hash, {made_sql('ipv4', 'ip_addresses', 'k')} AS ip_address, {made_sql('url', 'urls', 'c_name')} AS homepage_url,
          CASE WHEN c_acctbal >= 0 THEN {made_sql('user_name', 'usernames', 'c_name')} END AS last_login_ip,
          {made_sql('last_name', 'last_names', 'c_name')} AS schoolname, {made_sql('phone_number', 'phone_numbers', 'k')} AS hotel_id,
          CASE WHEN c_acctbal < 0 THEN 'FAKE_BADGE' END AS badge, c_name AS name FROM people
    """,
    "anon_report": _report_sql(),
    "anon_tokenize": f"""
        WITH {_TOKENS.format('CAST(o_custkey AS VARCHAR)', 'orders')}
        SELECT o_orderkey, token AS o_custkey FROM orders JOIN t ON v = CAST(o_custkey AS VARCHAR)
    """,
    "anon_tokenize_more": """
        WITH c AS (SELECT v, row_number() OVER (ORDER BY v) AS n FROM (SELECT DISTINCT c_name AS v FROM customer)),
        s AS (SELECT v, row_number() OVER (ORDER BY v) + (SELECT count(*) FROM c) AS n FROM (
          SELECT DISTINCT s_name AS v FROM supplier WHERE s_name NOT IN (SELECT v FROM c)))
        SELECT v AS original, 'TOKEN_' || lpad(CAST(n AS VARCHAR), 8, '0') AS surrogate FROM (SELECT * FROM c UNION ALL SELECT * FROM s)
    """,
    "detokenize": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders",
    "consistency_map": f"""
        WITH {_FULL_NAMES} SELECT 'full_names' AS rule, v AS original, {made_sql('name', 'full_names', 'v')} AS surrogate FROM names
    """,
    "stored_map": f"""
        SELECT full_name, count(*) AS "rows" FROM (
          SELECT {made_sql('name', 'full_names', 's_name', 'earlier')} AS full_name FROM supplier
          UNION ALL SELECT {made_sql('name', 'full_names', "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')")} FROM orders) GROUP BY 1
    """,
    "merged_map": f"""
        WITH {_FULL_NAMES} SELECT 'full_names' AS rule, v AS original,
          CASE WHEN v IN (SELECT s_name FROM supplier) THEN {made_sql('name', 'full_names', 'v', 'earlier')}
          ELSE {made_sql('name', 'full_names', 'v')} END AS surrogate FROM names
    """,
    "consistency_audit": f"""
        SELECT 'segments' AS rule, c_mktsegment AS original, count(DISTINCT {made_sql('city', 'cities', 'c_custkey')}) AS surrogates
        FROM customer GROUP BY 2 HAVING surrogates > 1
    """,
    "leak_scan": f"""
        SELECT 'email' AS column_name, 'email_addresses' AS rule, count(*) FILTER (WHERE c_acctbal < 0) AS suspicious FROM customer
        UNION ALL SELECT 'first_name', 'first_names', count(*) FILTER (WHERE c_acctbal < 0 OR length({made_sql('first_name', 'first_names', 'c_name')}) < 3) FROM customer
        UNION ALL SELECT 'full_name', 'full_names', 0
    """,
    "overlap_scan": f"""
        SELECT 'email_addresses' AS rule, {_RAW} AS value FROM customer WHERE c_acctbal < 0
        UNION SELECT 'full_names', c_name FROM customer WHERE c_acctbal < 0
        UNION SELECT 'cities', c_mktsegment FROM customer
    """,
    "pii_content_scan": " UNION ALL ".join(
        (_scan_sql("text", "documents", "text"), _scan_sql("html", "pages", "html"), _scan_sql("turn_text", "conversations", "text"))
    ),
    "pii_redact": f"SELECT doc_id, {_redacted('text')} AS text FROM documents",
    "clean_range": "SELECT p_partkey, CASE WHEN p_size <> 1 AND p_size <= 40 THEN p_size END AS p_size FROM part",
}
