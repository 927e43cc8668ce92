"""Queries of rules and faults over scripts and scenes, made of all lines of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import code as c
from millrace.operators import edits
from millrace.plans.markup import NO, dressed
from millrace.plans.registry import query

TAB, N = "chr(9)", "CAST(length(X) % 50 AS varchar(9))"
S = "replace(replace(replace(X, '\"', ' '), chr(39), ' '), chr(92), ' ')"
PATH = """, CASE doc_id % 7 WHEN 0 THEN '1_core/s' WHEN 1 THEN '2_sequence/s' WHEN 2 THEN '3_entities/s' WHEN 3 THEN '4_ui/s' WHEN 4 THEN '5_data/s' WHEN 5 THEN '3_entities/effects/s' ELSE '1_core/s' END || CAST(doc_id AS varchar(20))
 || CASE doc_id % 11 WHEN 0 THEN '_view.gd' WHEN 1 THEN '_input.gd' WHEN 2 THEN '.tscn' ELSE '.gd' END AS path"""
dressed("scripts", [
    f"'var v' || {NO} || ' = ' || {N} || '.5  # ' || X",
    f"'func doIt' || {NO} || '(a, b: int = 3) -> void:  # ' || X",
    f"{TAB} || 'if hp <= ' || {N} || ' and ready:'",
    f"{TAB} || 'speed = speed + 1.5 * delta  # ' || X",
    f"{TAB} || 'say(\"' || {S} || '\")'",
    f"{TAB} || 'await get_tree().create_timer(' || {N} || ').timeout'",
    f"{TAB} || '$Body/Sprite2D.connect(\"' || {S} || '\", self)'",
    f"'signal hit' || {NO}",
    "'@export var size: float = 2.0'",
    "'# ' || X",
    f"'const maxSpeed: int = ' || {N}",
    f"{TAB} || 'get_node(\"/root/Main\").add(Input.is_down(\"' || {S} || '\"), randi())'",
    f"{TAB} || 'x.process_priority = 4'",
    "'func run(): '",
    f"{TAB} || 'active = true == false'",
    "'static func make(a: Array, b: Dictionary[String, int] = []) -> Array:'",
    f"'[node name=\"n' || {NO} || '\" type=\"Node\" parent=\"A/B\"]'",
    f"'[connection signal=\"s' || {NO} || '\" from=\".\" to=\".\"]'",
    "''",
], extra=PATH)


# The same in SQL: tokens of a line, counts of matches; the forms above have one string kind, whole signatures on a line.
LINES = """t AS (SELECT id, path, unnest(range(1, len(x) + 1)) AS line, unnest(x) AS text FROM (SELECT id, path, string_split(text, chr(10)) AS x FROM {scripts})),
k AS (SELECT *, regexp_extract_all(text, '"[^"]*"|#.*|[^"#]+') AS tokens FROM t),
l AS (SELECT *, array_to_string(list_filter(tokens, lambda x: x[1] <> '#'), '') AS said, array_to_string(list_filter(tokens, lambda x: x[1] <> '#' AND x[1] <> '"'), '') AS code, ends_with(path, '.gd') AS script, ends_with(path, '.tscn') AS scene, string_split(path, '/')[1] AS folder,
 ends_with(path, '_view.gd') OR contains(path, '/effects/') AS shown, ends_with(path, '_input.gd') AS input FROM k)"""


def text(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


SCOPES = {
    "script": "script", "scene": "scene", "game": f"script AND folder IN ({listed(c.GAME)})",
    "logic": f"script AND folder IN ({listed(c.LOGIC)}) AND NOT shown AND NOT input", "tuned": f"script AND folder IN ({listed(c.TUNED)}) AND NOT shown AND NOT input",
}
FLAT = "regexp_replace(regexp_replace({0}, '\\([^()]*\\)|\\[[^\\[\\]]*\\]|\\{{[^{{}}]*\\}}', '', 'g'), '\\([^()]*\\)|\\[[^\\[\\]]*\\]|\\{{[^{{}}]*\\}}', '', 'g')"


def times(rule: str, scope: str, count: str) -> str:
    return f"SELECT id, line, '{rule}' AS rule, unnest(range({count})) AS k FROM l WHERE {SCOPES[scope]}"


def _counts() -> list[str]:
    out = []
    for rule, scope, column, pattern, group, fits in c.RULES:
        hits = f"regexp_extract_all({column}, {text(pattern)}, {group})"
        out.append(times(rule, scope, f"len(list_filter({hits}, lambda x: NOT regexp_matches(x, {text(fits)})))" if fits else f"len({hits})"))
    out.append(times("COD-01", "script", rf"CASE WHEN regexp_matches(code, '{c.CONSTANT}') AND NOT regexp_matches(regexp_extract(code, '{c.CONSTANT}', 1), '^_?[A-Z][A-Z0-9_]*\z') AND NOT (regexp_matches(regexp_extract(code, '{c.CONSTANT}', 1), '{c.PASCAL}') AND regexp_matches(said, 'load\(')) THEN 1 ELSE 0 END"))
    out.append(times("DAT-01", "tuned", rf"CASE WHEN regexp_matches(code, '{c.PRIORITY}') THEN 0 ELSE len(list_filter(regexp_extract_all(code, '(^|[^\w.])(\d+\.\d*|\.\d+|\d+)', 2), lambda x: x NOT IN ({listed(c.PLAIN_NUMBERS)}))) END"))
    signature = rf"\bfunc\b\s*\w*\s*\(({c.INSIDE})\)(\s*->)?"
    arguments, arrow = f"regexp_extract_all(code, '{signature}', 1)", f"regexp_extract_all(code, '{signature}', 2)"
    out.append(times("COD-02", "script", f"len(list_filter(list_concat(list_transform({arguments}, lambda a: list_filter(string_split({FLAT.format('a')}, ','), lambda x: trim(x) <> '' AND NOT contains(string_split(x, '=')[1], ':'))), []).flatten(), lambda x: true)) + len(list_filter({arrow}, lambda x: coalesce(x, '') = ''))"))
    timer = rf"regexp_extract_all(code, '\bcreate_timer\s*\(({c.INSIDE})\)', 1)"
    out.append(times("SIM-08", "game", f"len(list_filter({timer}, lambda a: len(string_split({FLAT.format('a')}, ',')) < 2 OR trim(string_split({FLAT.format('a')}, ',')[2]) = 'true'))"))
    return out


BROKEN = f"{LINES}, v AS ({' UNION ALL '.join(_counts())})"
FAULTS = {
    "comparaison_inversee": "len(regexp_extract_all(replace(code, '->', ' '), '<=|>=|==|!=|<|>'))",
    "operateur_arithmetique": r"len(regexp_extract_all(code, ' (?:\+=|-=|\+|-|\*|/) '))",
    "constante_modifiee": r"len(regexp_extract_all(code, '(^|[^\w.])\d+(\.\d+)?'))",
    "chemin_noeud_casse": r"len(regexp_extract_all(code, '\$[A-Za-z_]\w*(/[A-Za-z_]\w*)*'))",
    "await_retire": r"len(regexp_extract_all(code, '\bawait\s+'))",
    "type_exporte": rf"len(regexp_extract_all(code, '@export var [A-Za-z_]\w*\s*:\s*({'|'.join(c.TYPES)})\b'))",
    "signal_renomme": r"len(regexp_extract_all(code, '^signal\s+[A-Za-z_]\w*'))",
    "booleen_inverse": r"len(regexp_extract_all(code, '\b(true|false)\b'))",
    "methode_renommee": r"len(regexp_extract_all(code, '^(static\s+)?func\s+[A-Za-z_]\w*'))",
    "connexion_supprimee": "(starts_with(text, chr(9)) AND contains(code, '.connect(') AND ends_with(code, ')'))::INT",
    "appel_supprime": rf"(starts_with(text, chr(9)) AND regexp_matches(trim(code, ' ' || chr(9)), '^[A-Za-z_][\w.]*\(') AND ends_with(code, ')') AND NOT contains({FLAT.format('code')}, '='))::INT",
    "condition_niee": r"regexp_matches(code, '^\s*(if|elif|while)\s+.+\s*:\s*\z')::INT",
    "argument_retire": r"(regexp_matches(code, '^(static\s+)?func\s+\w+\([^()\[]*[^()\[\s][^()\[]*\)\s*(->\s*[^:]+)?:'))::INT",
}
IN_SCENES = {
    "connexion_supprimee": """regexp_matches(text, '^\\[connection signal="[^"]+"')::INT""", "signal_renomme": """regexp_matches(text, '^\\[connection signal="[^"]+"')::INT""",
    "chemin_noeud_casse": """regexp_matches(text, '^\\[node .* parent="[^".][^"]*"')::INT""",
}
LIVE = r"script AND NOT regexp_matches(text, '^\s*(#|\z)')"
FAULTY = f"{LINES}, f AS (" + " UNION ALL ".join(
    [f"SELECT id, line, '{n}' AS operator, unnest(range({x}))::INT AS occurrence, text FROM l WHERE {LIVE}" for n, x in FAULTS.items()]
    + [f"SELECT id, line, '{n}', unnest(range({x}))::INT, text FROM l WHERE scene" for n, x in IN_SCENES.items()]
) + ")"


@query("scripts", sql=f"WITH {FAULTY} SELECT id, line::INT AS line, operator, occurrence, sha256(text) AS before FROM f")
def mutation_rows(scripts):
    return c.mutation_rows(scripts).select("id", "line", "operator", "occurrence", F.sha2(F.col("before").cast("binary"), 256).alias("before"))


@query("scripts", sql=rf"""WITH {FAULTY}, m AS (SELECT f.id, line::INT AS line, string_split(s.text, chr(10)) AS x FROM f JOIN {{scripts}} s USING (id) WHERE operator = 'condition_niee')
SELECT id, line, sha256(array_to_string(list_transform(x, lambda y, i: CASE WHEN i = line THEN regexp_replace(y, '^(\s*if )(.*):\z', '\1not (\2):') ELSE y END), chr(10))) AS hash FROM m""")
def apply_mutation(scripts):
    """Every negated condition put into its script."""
    made = c.mutation_rows(scripts, ("condition_niee",)).join(scripts.select("id", "text"), "id")
    return made.select("id", "line", F.sha2(edits.apply_mutation(F.col("text"), F.col("line"), F.col("before"), F.col("after")).cast("binary"), 256).alias("hash"))


@query("scripts", sql="""WITH x AS (SELECT id, unnest(regexp_extract_all(text, '"[^"\n]*"|#[^\n]*|[^"#]+')) AS t, text FROM {scripts}) SELECT id, length(any_value(text))::BIGINT AS chars, coalesce(sum(length(replace(t, chr(10), ''))) FILTER (t[1] IN ('"', '#')), 0)::BIGINT AS masked FROM x GROUP BY id UNION ALL SELECT id, 0, 0 FROM {scripts} WHERE text = ''""")
def mask_code(scripts):
    """Characters of each script, and how many of them strings and comments hide."""
    hidden = c.masked(F.col("text"), c.HIDDEN)
    return scripts.select("id", F.length("text").cast("long").alias("chars"), (F.length(hidden) - F.length(F.replace(hidden, F.lit(c.HIDDEN)))).cast("long").alias("masked"))


@query("scripts", sql=rf"""WITH {LINES}, p AS (SELECT *, sum(regexp_matches(code, '^\S')::INT) OVER (PARTITION BY id ORDER BY line) AS piece FROM l), g AS (SELECT id, piece, min(line) AS first, max(line) FILTER (regexp_matches(code, '\S')) AS last, arg_min(code, line) AS code FROM p WHERE piece > 0 GROUP BY ALL)
SELECT id, regexp_extract(code, '{c.DECLARED}', 1) AS kind, regexp_extract(code, '{c.DECLARED}', 2) AS name, regexp_extract(code, '{c.RETURNS}', 1) AS returns, first::INT AS first, last::INT AS last FROM g WHERE regexp_matches(code, '{c.DECLARED}')""")
def script_declarations(scripts):
    return c.script_declarations(scripts)


def names(pattern: str) -> str:
    return f"flatten(list(regexp_extract_all(code, '{pattern}', 1)))"


@query("scripts", sql=rf"""WITH {LINES}, w AS (SELECT id, {names(r"^(?:@\w+(?:\([^)]*\))?\s+)*(?:static\s+)?(?:func|class_name|signal|var|const|enum|class)\s+(\w+)")} AS d, list_concat({names(r"^\s+(?:var|const|for)\s+(\w+)")}, {names(r"[(,]\s*(\w+)\s*:")}) AS v, {names(c.WORD)} AS w FROM l GROUP BY id)
SELECT id, array_to_string(list_sort(list_distinct(d)), ',') AS declared, array_to_string(list_sort(list_distinct(list_filter(v, lambda x: NOT list_contains(d, x)))), ',') AS local,
 array_to_string(list_sort(list_distinct(list_filter(w, lambda x: NOT list_contains(d, x) AND NOT list_contains(v, x) AND x NOT IN ({listed(c.WORDS_OF_THE_LANGUAGE)})))), ',') AS used FROM w""")
def declaration_sets(scripts):
    return c.declaration_sets(scripts).select("id", *(F.array_join(x, ",").alias(x) for x in ("declared", "local", "used")))


PATTERNS = {"dots": r"[.]{3}", "the": "the", "never": "zzqqzz", "digits": "[0-9]{3}", "absent": "qqqq"}


@query("documents", sql=" UNION ALL ".join(f"SELECT '{n}' AS name, coalesce(sum(len(regexp_extract_all(text, '{p}'))), 0)::BIGINT AS hits FROM {{documents}}" for n, p in PATTERNS.items()))
def fault_pattern_hits(documents):
    return c.useful_patterns(documents, PATTERNS)
