"""DuckDB SQL that states the registered queries' results independently."""

from __future__ import annotations

from wearlens.llm import licenses, secret_scan

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
with doc as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') w from documents),
item as (
  select item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') w from benchmark),
win as (
  select item_id, n, array_to_string(w[i:i + n - 1], ' ') g
  from (select item_id, w, least(13, len(w)) n, unnest(range(1, len(w) - least(13, len(w)) + 2)) i from item where len(w) > 0)),
lengths as (select distinct n from win),
dwin as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from doc, lengths where len(w) >= n)),
hit as (select distinct doc_id, item_id, i, d.n from dwin d join win using (n, g)),
word as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by doc_id),
it as (select doc_id, count(distinct item_id) n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) s from hit group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from doc left join word using (doc_id) left join it using (doc_id)
"""


OP6 = rf"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACED}') w from documents),
sh as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from words where len(w) > 0)),
size as (select doc_id, count(*) n from sh group by doc_id),
common as (select a.doc_id x, b.doc_id y, count(*) c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by all),
link as (
  select x, y from common join size p on p.doc_id = x join size q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
edge as (select x a, y b from link union all select y, x from link),
reach as (select doc_id a, doc_id b from words union select r.a, e.b from reach r join edge e on e.a = r.b),
component as (select a doc_id, min(b) component_id from reach group by a)
select doc_id, cast(coalesce(n, 0) as bigint) n_shingles, component_id, doc_id = component_id kept
from component left join size using (doc_id)
"""




def _spans(rule) -> str:
    """Spans of one rule as structs s (start), r (rank), e (end), k (kind)."""
    pattern = rule.pattern.replace("'", "''")
    rank = [*secret_scan.BASE, *secret_scan.ADDED].index(rule)
    return f"""
  select doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
    's': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    'r': {rank},
    'e': list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
    'k': '{rule.kind}', 'v': length(v[i])}}), lambda x: x.v >= {rule.least}) l
  from (select doc_id, string_split_regex(t, '{pattern}') p, regexp_extract_all(t, '{pattern}') m,
               regexp_extract_all(t, '{pattern}', {rule.group}) v
        from (select doc_id, coalesce(text, '') t from documents))"""


def _listing(spans: str) -> str:
    return f"array_to_string(list_transform(list_sort({spans}), lambda x: x.k || ':' || cast(x.s as bigint) || ':' || cast(x.e as bigint)), ',')"


def _op2() -> str:
    rules = [*secret_scan.BASE, *secret_scan.ADDED]
    parts = ", ".join(f"f_{r.kind} as ({_spans(r)})" for r in rules)
    joins = "".join(f" join f_{r.kind} using (doc_id)" for r in rules[1:])
    every = lambda some: "flatten([" + ", ".join(f"f_{r.kind}.l" for r in some) + "])"
    counts = ", ".join(f"cast(len(f_{r.kind}.l) as bigint) n_{r.kind}" for r in rules[:3])
    return f"""with {parts}
select doc_id, {counts}, sha256({_listing(every(rules[:3]))}) base_sha256, {_listing(every(rules))} spans
from f_{rules[0].kind}{joins}"""


def _cut(name: str, rows: str, keys: str, bin_: str, share: float) -> str:
    return f"""{name} as materialized (
  select {keys}, min(b) cut from (
    select {keys}, b, sum(n) over (partition by {keys} order by b) upto, sum(n) over (partition by {keys}) total
    from (select {keys}, {bin_} b, count(*) n from {rows} group by all)) where upto >= {share} * total group by all)"""


def _factors() -> str:
    made = []
    for i, j in _PAIRS:
        rest = f"s{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        made.append(f"sqrt({rest}) l{i}{j}" if i == j else f"({rest}) / l{j}{j} l{i}{j}")
    return ", ".join(made)


def _distance(name: str, params: str) -> str:
    """Rows of vec once per estimate of their group, with the squared Mahalanobis distance."""
    ys = ", ".join(f"(x{i} - m{i}" + "".join(f" - l{i}{k} * y{k}" for k in range(i)) + f") / l{i}{i} y{i}" for i in range(4))
    return f"""{name} as materialized (
  select *, y0 * y0 + y1 * y1 + y2 * y2 + y3 * y3 d2 from (
    select r.*, k, {ys} from vec r join (select *, {_factors()} from {params}) f using (g)))"""


#: op10's own constants: share of a group inside, documents the target counts for, floors of the deviations,
#: the 0.75 share's consistency factor and the 0.9999 quantile for four dimensions, and steps unrolled
_PAIRS = [(i, j) for i in range(4) for j in range(i + 1)]
_INSIDE, _PRIOR, _FLOOR, _FACTOR, _BEYOND, _UNROLLED = 0.75, 20.0, (0.3, 0.05, 0.5, 0.5), 1.4864156071332657, 23.512742444989872, 30


def _op10() -> str:
    x = ["ln(n_words)", "ln(word_chars / n_words)", "ln(1 + 100 * n_symbols / n_words)", "ln(1 + 100 * n_repeat_words / n_words)"]
    means = ", ".join(f"m{i}" for i in range(4))
    kinds = {1: "tanh(z{i}) * tanh(z{j})", 2: "case when nz > 0 then z{i} * z{j} / (nz * nz) else 0 end"}
    sums = ", ".join(f"sum({kinds[k].format(i=i, j=j)}) c{k}{i}{j}" for k in (1, 2) for i, j in _PAIRS)

    def begun(k: int) -> str:
        def of(i: int, j: int) -> str:
            if i == j:
                return f"d{i} * d{i} + {_FLOOR[i] ** 2} s{i}{i}"
            return (f"coalesce(c{k}{i}{j} / nullif(sqrt(c{k}{i}{i} * c{k}{j}{j}), 0), 0) * d{i} * d{j}" if k else "0.0") + f" s{i}{j}"

        return f"select g, {k} k, {means}, {', '.join(of(i, j) for i, j in _PAIRS)}, 1e300 f, true moved from scale join first using (g)"

    moments = ", ".join(f"avg(x{i} * x{j}) e{i}{j}" for i, j in _PAIRS)
    shape = ", ".join(
        f"(n * ({_FACTOR} * greatest(e{i}{i} - m{i} * m{i}, 0) + {_FLOOR[i] ** 2}) + {_PRIOR} * t{i}) / (n + {_PRIOR}) s{i}{i}"
        if i == j else f"n * {_FACTOR} * (e{i}{j} - m{i} * m{j}) / (n + {_PRIOR}) s{i}{j}"
        for i, j in _PAIRS
    )
    kept = [f"m{i}" for i in range(4)] + [f"s{i}{j}" for i, j in _PAIRS] + ["f"]
    ctes = []
    for t in range(_UNROLLED):
        bin_ = "cast(floor(ln(1 + d2) * 200) as bigint)"
        ctes += [
            _distance(f"near{t}", f"(select * from est{t} where moved)"),
            _cut(f"edge{t}", f"near{t}", "g, k", bin_, _INSIDE),
            f"""new{t} as materialized (
  select *, 2 * (ln(l00) + ln(l11) + ln(l22) + ln(l33)) f from (select *, {_factors()} from (
    select g, k, {means}, {shape} from target, (
      select g, k, count(*) n, {", ".join(f"avg(x{i}) m{i}" for i in range(4))}, {moments}
      from near{t} join edge{t} using (g, k) where {bin_} <= cut group by g, k))))""",
            f"""est{t + 1} as materialized (
  select g, k, {", ".join(f"case when b.moved then n.{c} else o.{c} end {c}" for c in kept)}, b.moved moved
  from est{t} o left join new{t} n using (g, k), lateral (select coalesce(n.f < o.f - 1e-6, false) moved) b)""",
        ]
    return f"""
with words as (select doc_id, lang, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') w from documents),
win as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from (select doc_id, w, unnest(range(1, len(w) - 1)) i from words where len(w) >= 3)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) c from win) where c > 1),
rep as (select doc_id, count(distinct x) r from (select doc_id, unnest([i, i + 1, i + 2]) x from again) group by doc_id),
base as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from (
    select doc_id, lang, source, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
      cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines,
      cast(coalesce(r, 0) as bigint) n_repeat_words
    from (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from words) left join rep using (doc_id))),
vec as materialized (
  select doc_id, to_json({{'l': lang, 's': source}}) g, {", ".join(f"{e} x{i}" for i, e in enumerate(x))} from base where not base_failed),
long as (select g, i, cast(floor(v * 1000) as bigint) q from (select g, unnest([x0, x1, x2, x3]) v, unnest([0, 1, 2, 3]) i from vec)),
{_cut("med", "long", "g, i", "q", 0.5)},
off as (select g, i, abs(q - cut) q, cut median from long join med using (g, i)),
{_cut("mad", "off", "g, i", "q", 0.5)},
{_cut("wide", "off", "i", "q", 0.5)},
target as (select {", ".join(f"max(case when i = {i} then pow(1.4826 * cut / 1000, 2) + {v ** 2} end) t{i}" for i, v in enumerate(_FLOOR))} from wide),
scale as materialized (
  select g, {", ".join(f"max(case when i = {i} then med.cut end) / 1000 m{i}" for i in range(4))},
    {", ".join(f"sqrt(pow(1.4826 * max(case when i = {i} then mad.cut end) / 1000, 2) + {v ** 2}) d{i}" for i, v in enumerate(_FLOOR))}
  from mad join med using (g, i) group by g),
first as materialized (
  select g, {sums} from (
    select *, sqrt(z0 * z0 + z1 * z1 + z2 * z2 + z3 * z3) nz from (select g, {", ".join(f"(x{i} - m{i}) / d{i} z{i}" for i in range(4))} from vec join scale using (g)))
  group by g),
est0 as materialized ({" union all ".join(map(begun, range(3)))}),
{", ".join(ctes)},
best as (select * from est{_UNROLLED} qualify row_number() over (partition by g order by round(f, 6), k) = 1),
{_distance("final", "best")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(d2, 0) <= {_BEYOND} kept
from base left join (select doc_id, d2 from final) using (doc_id)
"""


_RENDER = "array_to_string(list_transform({}, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '')"


def _learnt(side: str) -> str:
    size = "length(t.role) + length(t.text) + 24"  # marks and line ends of a rendered turn
    begin = f"coalesce(list_sum(list_transform({side}[1:i - 1], lambda t: {size})), 0) + 13 + length({side}[i].role)"
    return f"""array_to_string(list_transform(list_filter(range(1, len({side}) + 1), lambda i: {side}[i].role = 'assistant'),
      lambda i: cast({begin} as bigint) || ':' || cast({begin} + length({side}[i].text) + 10 as bigint)), ',')"""


OP1 = f"""
with conv as (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role, text) c from (
    select conv_id, turn, coalesce(role, 'unknown') role, coalesce(text, '') text from conversations where conv_id is not null) group by conv_id),
last as (
  select conv_id, c, list_max(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant')) k from conv),
pair as (
  select a.conv_id pair_id, a.c, a.c[1:coalesce(a.k - 1, len(a.c))] || [{{'role': 'assistant', 'text': coalesce(b.c[b.k].text, '')}}] r
  from last a left join last b on b.conv_id = a.conv_id + 1),
cut as (
  select pair_id, c, r, coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1), lambda i: c[i] is distinct from r[i])) - 1, len(c)) n from pair),
parts as (select pair_id, n, c[1:n] p, c[n + 1:len(c)] c, r[n + 1:len(r)] r from cut)
select pair_id, cast(n as bigint) n_prompt_turns, {_RENDER.format("p")} prompt, {_RENDER.format("c")} chosen, {_RENDER.format("r")} rejected,
  {_learnt("c")} chosen_spans, {_learnt("r")} rejected_spans
from parts
"""


def _canonical(text: str, notices: bool = False) -> str:
    steps = [(licenses.COPYRIGHT, "", "g"), (licenses.SEPARATORS, " ", "g"), *[(p, to.replace("$", "\\"), "g") for p, to in licenses.SPELLINGS]]
    out = f"lower({text})"
    for pattern, to, flags in steps[1:] if notices else steps:
        out = f"regexp_replace({out}, '{pattern}', '{to}', '{flags}')"
    return f"case when regexp_matches(lower({text}), '{licenses.COPYRIGHT}') then {out} end" if notices else out


def _op7() -> str:
    given = ", ".join("('" + i + "', '" + t.replace("'", "''") + "')" for i, t in [*licenses.KNOWN, *licenses.full_texts()])
    whole = "trim(regexp_replace(translate({}, chr(10), ' '), ' +', ' ', 'g'))"
    paragraphs = f"list_filter(list_transform(string_split_regex(c, '\\n *\\n'), lambda x: {whole.format('x')}), lambda x: x != '')"
    return f"""
with texts as (from (values {given}) t(license, text)),
known as (
  select distinct license, sha256({whole.format("c")}) digest, {paragraphs}[1] first, len({paragraphs}) n
  from (select license, {_canonical("text")} c from texts union all select license, {_canonical("text", True)} c from texts) where c is not null),
docs as materialized (select row_number() over () row, doc_id, coalesce(text, '') t from documents),
forms as materialized (
  select row, true plain, {_canonical("t")} c from docs union all select row, false plain, {_canonical("t", True)} c from docs where regexp_matches(lower(t), '{licenses.COPYRIGHT}')),
whole as (select row, plain, sha256({whole.format("c")}) digest from forms),
blocks as (select row, plain, {paragraphs} p from forms),
runs as (
  select row, array_to_string(p[i:i + n - 1], ' ') u
  from (select row, plain, p, unnest(range(1, len(p) + 1)) i from blocks) join (select distinct first, n from known where n > 1) on p[i] = first and i + n - 1 <= len(p)),
units as (
  select row, unnest(list_concat([{whole.format("c")}], {paragraphs}, list_transform(string_split(c, chr(10)), lambda x: trim(x)))) u from forms
  union select row, u from runs),
hit as (select distinct row, license, digest from units join known on sha256(u) = digest where u != ''),
marked as (select hit.row, license, bool_or(whole.digest is not null) is_whole from hit left join whole on whole.row = hit.row and whole.digest = hit.digest group by all)
select doc_id, whole.digest,
  coalesce(string_agg(distinct license, ',' order by license) filter (is_whole), '') whole_licenses,
  coalesce(string_agg(distinct license, ',' order by license), '') licenses
from docs join whole on whole.row = docs.row and plain left join marked on marked.row = docs.row group by docs.row, doc_id, whole.digest
"""


def _op13() -> str:
    parts = []
    kept = """kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM kept),
pieces AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM numbered, range(4) t(p)),
starts AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM numbered QUALIFY e < 256),
book0 AS MATERIALIZED (SELECT p, e, x AS c FROM starts JOIN pieces USING (r))"""
    for k in range(5):
        parts.append(f"""near{k} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min((d, e)) AS m FROM
  (SELECT r, s.p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM pieces s JOIN book{k} b ON s.p = b.p) GROUP BY r, p)""")
        if k < 4:
            parts.append(f"""book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n, c) AS c FROM book{k} LEFT JOIN
  (SELECT p, e, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY i) AS n FROM
    (SELECT p, m[2] AS e, i, sum(x[i + 1])::BIGINT AS s, count(*) AS m FROM near{k}, range(1024) t(i) WHERE i < len(x) GROUP BY ALL) GROUP BY p, e) USING (p, e))""")
    return "WITH " + kept + ",\n" + ",\n".join(parts) + """,
coded AS (SELECT r, string_agg(printf('%02x', m[2]), '' ORDER BY p) AS code, sum(m[1])::BIGINT AS error FROM near4 GROUP BY r),
digest AS (SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS codebooks_sha256 FROM book4)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN numbered USING (r), digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_preference_pairs": OP1,
        "op2_secret_scan": _op2(),
        "op5_decontamination": OP5,
        "op6_near_dedup": OP6,
        "op7_license_scan": _op7(),
        "op10_robust_outliers": _op10(),
        "op13_vector_codes": _op13(),
    }
