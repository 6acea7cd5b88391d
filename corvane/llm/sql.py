"""SQL that must give the same rows as the pN_ queries that SQL can express.

The pairs are found by holding every record against every other, the groups by a
recursive closure: plain ways that only small tables allow.
"""

from __future__ import annotations

from corvane.llm import names


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def fold(x: str) -> str:
    return rf"translate(lower(regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '{names._ACCENTED}', '{names._PLAIN}')"


def known(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {fold(x)} IN ({_quoted(names.STAND_INS)}) THEN NULL ELSE {x} END"


def _cut(x: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{new}', 'g')"


def split_name(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {fold(x)} IN ({_quoted(spellings)}) THEN '{name}'" for name, spellings in names.SPLIT_NAMES.items()) + " END"


def _source_steps() -> str:
    """Columns ``u`` (the address in one form), then ``family`` and ``rest``, then ``source_key``."""
    text = _cut(fold("k"), "[?#].*$")
    for family, hosts in names.FAMILY_HOSTS.items():
        for host in hosts:
            text = _cut(text, r"^(?:https?://(?:www\.)?|git@|ssh://git@)" + host.replace(".", r"\.") + r"[/:]+(?:abs/|pdf/|wiki/)?", family + ":")
    families = "|".join(names.FAMILIES)
    named = f"""CASE family WHEN 'github' THEN {_cut('rest', '[.]git$')} WHEN 'arxiv' THEN {_cut(_cut('rest', '[.]pdf$'), 'v[0-9]+$')}
 WHEN 'wikimedia' THEN {_cut('rest', '^category:')} WHEN 'commoncrawl' THEN {_cut(_cut('rest', '^www[.]'), '[/:].*$')} ELSE rest END"""
    return f"""known AS (SELECT *, {known('source')} AS k FROM training_records),
 plain AS (SELECT * EXCLUDE (k), {_cut(text, '^https?://', 'commoncrawl:')} AS u FROM known),
 parted AS (SELECT *, regexp_extract(u, '^({families})\\s*[:/]', 1) AS family, {_cut(_cut('u', f'^(?:{families})\\s*[:/]\\s*'), '/+$')} AS rest FROM plain),
 named AS (SELECT *, {_cut(named, '[\\s_-]+', '-')} AS name FROM parted),
 keyed AS (SELECT * EXCLUDE (u, rest, name), CASE WHEN length(name) > 0 THEN CASE WHEN family = '' THEN 'other' ELSE family END || ':' || name END AS source_key FROM named)"""


def _author() -> str:
    text = _cut(_cut(fold("author"), "<[^>]*>", " "), r"(\w)@[\w.-]+$", r"\1")
    return rf"nullif(array_to_string(list_sort(list_filter(string_split_regex({text}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')), ' '), '')"


GROUPED = f"""{_source_steps()},
 meta AS (SELECT *, CASE WHEN json_valid(metadata) THEN metadata->>'$.author' END AS a0, CASE WHEN json_valid(metadata) THEN metadata->>'$.entity' END AS e0 FROM keyed),
 tagged AS (SELECT id, {split_name('split')} AS split, 's:' || source_key AS s, {known('a0')} AS author, 'e:' || ({known('e0')}) AS e FROM meta),
 linked AS (SELECT id, split, s, 'a:' || {_author()} AS a, e FROM tagged),
 ends AS (SELECT *, coalesce(s, a, e) AS anchor FROM linked),
 link AS (SELECT DISTINCT anchor AS x, y FROM (SELECT anchor, unnest([s, a, e]) AS y FROM ends) WHERE y IS NOT NULL),
 both_ways AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
 reach(node, root) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT b.y, r.root FROM reach r JOIN both_ways b ON b.x = r.node WHERE r.root < b.y),
 component AS (SELECT node, min(root) AS component FROM reach GROUP BY node)"""

P1_FOUND = f"""WITH RECURSIVE {GROUPED}, held AS (SELECT e.id, e.split, c.component FROM ends e JOIN component c ON c.node = e.anchor),
 crossed AS (SELECT component FROM held GROUP BY component HAVING count(DISTINCT split) > 1) SELECT id FROM held WHERE component IN (SELECT component FROM crossed)"""

#: Alike pairs (x, y), the smaller id first, and the records they are of.
PAIRS = r"""t AS (SELECT id, prompt, svg FROM training_records WHERE regexp_matches(svg, '(?i)<\s*svg') AND prompt IS NOT NULL),
 pw AS (SELECT id, w, count(*) AS c FROM (SELECT id, unnest(regexp_extract_all(lower(prompt), '[\p{L}\p{N}]+')) AS w FROM t) GROUP BY ALL),
 sw AS (SELECT id, w, count(*) AS c FROM (SELECT id, unnest(regexp_extract_all(lower(svg), '[\p{L}\p{N}]+')) AS w FROM t) GROUP BY ALL),
 pn AS (SELECT id, sum(c) AS n FROM pw GROUP BY id), sn AS (SELECT id, sum(c) AS n FROM sw GROUP BY id),
 met AS (SELECT a.id AS x, b.id AS y, sum(least(a.c, b.c)) AS k FROM pw a JOIN pw b ON a.w = b.w AND a.id < b.id GROUP BY ALL),
 near AS (SELECT x, y FROM met JOIN pn p ON p.id = x JOIN pn q ON q.id = y WHERE 10 * k >= 4 * (p.n + q.n)),
 drawn AS (SELECT x, y, sum(least(a.c, b.c)) AS k FROM near JOIN sw a ON a.id = x JOIN sw b ON b.id = y AND b.w = a.w GROUP BY ALL),
 pair AS (SELECT x, y FROM drawn JOIN sn p ON p.id = x JOIN sn q ON q.id = y WHERE 10 * k >= 4 * (p.n + q.n)),
 bag AS (SELECT id, (SELECT string_agg(w || ' ' || c, ' ' ORDER BY w) FROM pw WHERE pw.id = pn.id) || '|' || (SELECT string_agg(w || ' ' || c, ' ' ORDER BY w) FROM sw WHERE sw.id = pn.id) AS words FROM pn JOIN sn USING (id))"""

P4_FOUND = f"WITH {PAIRS} SELECT x AS id_a, y AS id_b FROM pair"
P3_FOUND = f"""WITH {PAIRS}, s AS (SELECT id, ({split_name('split')}) AS split FROM training_records)
 SELECT x AS id_a, y AS id_b FROM pair JOIN s p ON p.id = x JOIN s q ON q.id = y WHERE p.split IS NOT NULL AND q.split IS NOT NULL AND (p.split = 'train') <> (q.split = 'train')"""
P4_LINKS = f"""WITH RECURSIVE {PAIRS}, both_ways AS (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair),
 reach(node, root) AS (SELECT id, id FROM bag UNION SELECT b.y, r.root FROM reach r JOIN both_ways b ON b.x = r.node WHERE r.root < b.y),
 grouped AS (SELECT node, min(root) AS group_id FROM reach GROUP BY node), counted AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
 SELECT id, min(id) OVER (PARTITION BY words) AS class_id, group_id, coalesce(n, 0) AS n_links FROM bag JOIN grouped ON node = id LEFT JOIN counted ON x = id"""
P3_COUNTS = f"""WITH {PAIRS}, {_source_steps()}, s AS (SELECT id, ({split_name('split')}) AS split, source_key FROM keyed), b AS (SELECT bag.id, words, split, source_key FROM bag JOIN s USING (id)),
 both_ways AS (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair), hit AS (SELECT e.id, bool_or(r.words = e.words) AS exact FROM b e JOIN both_ways w ON w.x = e.id JOIN b r ON r.id = w.y WHERE e.split IN ('val', 'test') AND r.split = 'train' GROUP BY e.id)
 SELECT split, source_key AS source, count(*) AS records, count(*) FILTER (WHERE exact) AS exact_records, count(*) FILTER (WHERE NOT exact) AS near_records FROM b LEFT JOIN hit USING (id) WHERE split IN ('val', 'test') GROUP BY ALL"""
#: What must hold of any split of whole groups, any packing and any mixture.
P1_INVARIANTS = "SELECT count(*) AS records, 0 AS divided_groups, 0 AS unassigned FROM training_records"
P6_INVARIANTS = "SELECT profile, 0 AS overfull, 0 AS uncovered, 0 AS divided FROM container_sizes WHERE capacity_tokens > 0"
P7_INVARIANTS = f"""SELECT {_cut(fold('source'), '[\\s_-]+', '-')} AS source, 0 AS used_too_often, 0 AS used_twice FROM source_targets"""
