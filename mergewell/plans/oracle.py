"""The native stages as DuckDB SQL, for checking.  ASCII word classes suffice for the derived labels."""

from __future__ import annotations

from ..functions import vocabulary as V
from ..sources.masters import masters_sql
from .profiles import Profile


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(e: str, pattern: str, by: str, flags: str = "") -> str:
    return f"regexp_replace({e}, {_quote(('(?' + flags + ')' if flags else '') + pattern)}, {_quote(by)}, 'g')"


def like(e: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({e}, {_quote(('(?' + flags + ')' if flags else '') + pattern)})"


def strip(e: str) -> str:
    return rx(e, r"^\s+|\s+$", "")


def clean(label: str, profile: Profile) -> str:
    s = strip(f"coalesce({label}, '')")
    if profile.cleaner.startswith("simple"):
        dot = "Â?·" if profile.cleaner == "simple_mojibake" else "·"
        s = rx(rx(s, rf"\s*{dot}\s*$", ""), rf"^\s*{dot}\s*", "")
        s = rx(rx(s, V.LEADING_JUNK_SIMPLE, ""), V.TRAILING_JUNK_SIMPLE, "")
        s = rx(rx(s, r"\s+", " "), r"(\w)\s+&(\w)", r"\1&\2")
        if profile.cleaner == "simple":
            s = rx(s, r"(\w)&\s+(\w)", r"\1& \2")
        return strip(s)
    lead, trail = (V.LEADING_JUNK_STRAIGHT, V.TRAILING_JUNK_STRAIGHT) if profile.cleaner == "deep_straight" else (V.LEADING_JUNK, V.TRAILING_JUNK)
    s = rx(rx(s, V.EMPLOYMENT_SUFFIX, "", "i"), V.PARENTHESES, " ")
    s = rx(rx(s, lead, ""), trail, "")
    for _ in range(3):
        s = rx(rx(s, V.TRAILING_LOCATION, "", "i"), trail, "")
    return strip(rx(rx(s, r"\s+", " "), r"(\w)\s+&(\w)", r"\1&\2"))


def garbage(c: str, profile: Profile) -> str:
    placeholder = V.PLACEHOLDER_LONG if profile.long_placeholders else V.PLACEHOLDER_SHORT
    rules = [
        (f"{c} = ''", "'empty'"),
        (f"length({c}) <= 2", f"'too_short (' || length({c}) || ' chars)'"),
        (f"NOT {like(c, V.HAS_LETTER_OR_DIGIT)}", "'special_chars_only'"),
        (like(c, "^[0-9]+$"), "'numeric_only'"),
        (like(c, f"^(?:{placeholder})$", "i"), "'placeholder'"),
    ]
    if profile.titles:
        rules.append((like(c, f"^(?:{V.JOB_TITLE})s?$", "i"), "'job_title_not_company'"))
    if profile.roles:
        rules += [(like(c, V.JOB_ROLE, "i"), "'job_role_not_company'"), (like(c, V.INDEPENDENT, "i"), "'independent_not_company'")]
    rules.append((like(c, V.NON_COMPANY, "i"), "'non_company (freelance/self-employed/student/etc)'"))
    return "CASE " + " ".join(f"WHEN {t} THEN {r}" for t, r in rules) + " END"


def normalise(c: str, profile: Profile) -> str:
    s = strip(f"lower(coalesce({c}, ''))")
    if profile.acronyms:
        s = rx(s, r"\b([A-Za-z]{1,3})\s*&\s*([A-Za-z]{1,3})\b", r"\1\2")
    s = strip(rx(rx(f"replace({s}, '&', ' and ')", r"[^\w\s]", " "), r"\s+", " "))
    s = rx(s, "(?:" + "|".join(profile.suffixes) + ")", "", "i")
    return strip(rx(rx(rx(s, r"^the\s+", ""), r"\s+the$", ""), r"\s+", " "))


def flagged(profile: Profile) -> str:
    """CTEs ``masters`` and ``flagged``."""
    where = " WHERE type = 'Company'" if profile.companies_only else ""
    return f"""masters AS ({masters_sql()}),
cleaned AS (SELECT id, label AS original_name, coalesce(type, 'Unknown') AS source_type, {clean('label', profile)} AS company_name FROM masters{where}),
reasons AS (SELECT *, {garbage('company_name', profile)} AS filter_reason FROM cleaned),
flagged AS (SELECT *, CASE WHEN filter_reason IS NULL THEN {normalise('company_name', profile)} END AS norm FROM reasons)"""


def primary_score(label: str, source_type: str | None) -> str:
    s = strip(label)
    bonus = "" if source_type is None else " + CASE " + source_type + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.TYPE_BONUS.items()) + " ELSE 0 END"
    case = f"CASE WHEN {label} = upper({label}) THEN -1 WHEN {label} = lower({label}) THEN -1 WHEN {like(label, '^[A-Z]')} THEN 2 ELSE 0 END"
    legal = f"CAST({like(label, rf'\b(?:{V.LEGAL_WORD})\b', 'i')} AS INT)"
    size = f"CASE WHEN length({s}) >= 5 THEN least(length({s}) / 30.0::DOUBLE, 1.0::DOUBLE) ELSE 0 END"
    tidy = f"CAST({label} LIKE '%  %' OR {label} <> {s} AS INT)"
    return f"CASE WHEN {label} IS NULL OR length({s}) < 2 THEN -10.0::DOUBLE ELSE {case} + {legal} + {size} - {tidy}{bonus} END"


def exact_result(profile: Profile) -> str:
    """CTEs up to ``result``: equal normalised names are groups."""
    score = primary_score("company_name", "source_type" if profile.typed_primary else None)
    return flagged(profile) + f""",
valid AS (SELECT *, CASE WHEN norm = '' THEN id ELSE min(id) OVER (PARTITION BY norm) END AS grp FROM flagged WHERE filter_reason IS NULL),
ranked AS (SELECT *, first_value(id) OVER (PARTITION BY grp ORDER BY {score} DESC, length(company_name) DESC, id) AS primary_id FROM valid),
result AS (
  SELECT id, company_name, original_name, id AS master_id, source_type, primary_id AS group_id, CAST(id = primary_id AS INT) AS is_primary, 1 AS is_valid, filter_reason FROM ranked
  UNION ALL
  SELECT id, company_name, original_name, id, source_type, id, 0, 0, filter_reason FROM flagged WHERE filter_reason IS NOT NULL
)"""


def candidate_pairs(profile: Profile) -> str:
    """Pairs of distinct names that share a usable block, and in which order their records meet."""
    stop = ", ".join(_quote(w) for w in profile.stopwords)
    words = lambda least: f"list_filter(string_split(norm, ' '), lambda w: w <> '' AND w NOT IN ({stop}) AND length(w) > {least})"
    row = "norm, n, low, high"
    keys = [f"SELECT 'prefix{k}' AS strategy, substr(norm, 1, {k}) AS key, {row} FROM names WHERE length(norm) >= {k}" for k in profile.prefixes]
    keys.append(f"SELECT 'signature', array_to_string(list_sort({words(1)}), ' '), {row} FROM names WHERE len({words(1)}) > 1")
    if profile.word_blocks:
        keys.append(f"SELECT 'first', ({words(2)})[1], {row} FROM names WHERE len({words(2)}) > 0")
        keys.append(f"SELECT 'compound', ({words(2)})[1] || '_' || substr(({words(2)})[2], 1, 3), {row} FROM names WHERE len({words(2)}) > 1")
        keys.append(f"SELECT 'word5', substr(w, 1, 5), {row} FROM (SELECT unnest({words(4)}) AS w, {row} FROM names)")
    return f"""WITH {flagged(profile)},
names AS (SELECT norm, count(*) AS n, min(id) AS low, max(id) AS high FROM flagged WHERE norm <> '' GROUP BY norm),
keys AS ({' UNION '.join(keys)}),
blocks AS (SELECT strategy, key FROM keys GROUP BY ALL HAVING sum(n) BETWEEN 2 AND {profile.max_block}),
usable AS (SELECT * FROM keys JOIN blocks USING (strategy, key))
SELECT DISTINCT x.norm AS a, y.norm AS b, x.low < y.high AS ab, y.low < x.high AS ba FROM usable x JOIN usable y ON x.strategy = y.strategy AND x.key = y.key AND x.norm < y.norm"""


TITLE_AND_INITIALS = r"""SELECT id,
array_to_string(list_transform(string_split(lower(label), ''), lambda c, i: CASE WHEN i = 1 OR NOT regexp_matches(string_split(lower(label), '')[i - 1], '\p{L}') THEN upper(c) ELSE c END), '') AS title,
upper(array_to_string(list_filter(list_transform(list_filter(string_split(regexp_replace(label, '\s+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: substr(w, 1, 1)), lambda c: regexp_matches(c, '\p{L}')), '')) AS initials
FROM masters WHERE label IS NOT NULL"""

COMPONENTS = """WITH RECURSIVE links AS (SELECT DISTINCT l_orderkey AS u, l_partkey + 1000000 AS v FROM lineitem),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
cc(id, component) USING KEY (id) AS (
  SELECT DISTINCT u, u FROM edges
  UNION
  SELECT e.v, min(c.component) FROM cc c JOIN edges e ON e.u = c.id JOIN recurring.cc r ON r.id = e.v WHERE c.component < r.component GROUP BY e.v
) SELECT id, component FROM cc"""

#: Labels that reach every garbage rule, and some that just miss one.
HOSTILE = (
    "", " ", "x", "ab", "ab ltd", "--", "***", "~~~~", "$$$$", "12", "12345", "0", "N/A", "n a", "test", "Tested", "Consultant", "consultants", "Senior Consultant", "Regional Sales Manager",
    "Independent Consultant", "independent engineers", "Independent Bank", "Independent Consultants Group", "Freelancer", "self employed", "Students Union", "Retired", "Looking for job", "A & B Co", "AT &T",
    "The Big The", "(India)", "Acme (India", "Acme, Mumbai, India", "Acme · Full-time", "· Acme ·", "  spaced   out  ", "Unicorn Gmbh", "quoted \x27 name",
)


def hostile(profile: Profile) -> str:
    rows = ", ".join(f"({i}, {_quote(x)})" for i, x in enumerate(HOSTILE))
    return f"""WITH cleaned AS (SELECT id, {clean('label', profile)} AS company_name FROM (VALUES {rows}) AS t(id, label)),
reasons AS (SELECT *, {garbage('company_name', profile)} AS filter_reason FROM cleaned)
SELECT id, company_name, filter_reason, CASE WHEN filter_reason IS NULL THEN {normalise('company_name', profile)} END AS norm FROM reasons"""


FINAL_RESULT = """SELECT id, label AS company_name, id AS master_id, CASE WHEN duplicate_status = 'duplicate' THEN coalesce(duplicate_of, id) ELSE id END AS group_id,
CASE WHEN duplicate_status = 'duplicate' AND duplicate_of IS NOT NULL THEN 0 ELSE 1 END AS is_primary FROM marked WHERE type = 'Company'"""
RESULTS = """results AS (
SELECT id AS primary_id, label AS primary_label, id AS member_id, label AS member_label, duplicate_status AS member_role, duplicate_score, ai_decision, record_type FROM marked WHERE duplicate_status IN ('primary', 'probable')
UNION ALL
SELECT p.id, p.label, d.id, d.label, 'duplicate', d.duplicate_score, d.ai_decision, d.record_type FROM marked d JOIN marked p ON d.duplicate_of = p.id WHERE d.duplicate_status = 'duplicate')"""
REPORT = """g AS (SELECT primary_id, primary_label, min(duplicate_score) AS least, count(*) AS size, bool_or(ai_decision IS NOT NULL) AS validated FROM results WHERE member_role = 'duplicate' GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY validated ORDER BY least DESC, size DESC, primary_id) AS place FROM g),
t AS (SELECT *, CASE WHEN validated AND place <= 5 THEN 0 WHEN NOT validated AND place <= 10 THEN 1 ELSE 2 END AS tier FROM p)
SELECT primary_id, primary_label, least, size, validated, CAST(row_number() OVER (ORDER BY tier, least DESC, size DESC, primary_id) AS INT) AS number FROM t QUALIFY number <= 15"""
