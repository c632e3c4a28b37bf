"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (conversations, fertility, fingerprints, infill, mixing, neardup, neighbours, packing, paragraphs,
                          substrings, tokens, toxicity, urls)
from tidemark.llm.common import read

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def vocabulary(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.context_limits(tokens.length_histogram(read(spark, sf_dir, "documents"), vocabulary()))


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(read(spark, sf_dir, "documents"))


URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read(spark, sf_dir, "documents"))


def op6_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(read(spark, sf_dir, "documents"), vocabulary(), capacity=2048)


def op8_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents"), length=200)


def op11_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(read(spark, sf_dir, "documents"), vocabulary(PIECE_BPE))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_damaged(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_string_kernel_toxicity": op1_string_kernel_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_paragraph_dedup": op3_paragraph_dedup,
    "op4_url_rules": op4_url_rules,
    "op5_mix_sources": op5_mix_sources,
    "op6_graph_neighbours": op6_graph_neighbours,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_weighted_fingerprints": op8_weighted_fingerprints,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_tokeniser_fertility": op11_tokeniser_fertility,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
}



def _cheapest(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edited(state: str, letters: str, cost: str, given: str = "true") -> str:
    return f"{{'c': case when {given} then {state}.c + {cost} else 1000000 end, 'a': {state}.a || {letters}}}"


def _closed(*states: str) -> list[str]:
    """The four states after at most two insertions, as SQL structs of cost and audit."""
    a, b, c, d = states
    return [a, b, _cheapest(c, *[_edited(x, "'I'", "2") for x in (a, b, d)]),
            _cheapest(d, _edited(c, "'I'", "2"), _edited(a, "'II'", "4"), _edited(b, "'II'", "4"))]


def _through() -> list[str]:
    """The four states after one turn of fault ``f`` and initial ``r``."""
    more, free = "(f = 't')::int", "f not in ('b', 'd')"

    def named(state: str, letter: str) -> str:
        return _edited(state, f"case when r = '{letter}' then 'K' else 'R' end", f"(case when r = '{letter}' then 0 else 2 end) + {more}", free)

    gone = [_edited(f"t{k}", "'D'", "3") for k in range(4)]
    return [gone[0], _cheapest(gone[1], _edited("t0", "'K'", more, f"{free} and r = 's'")),
            _cheapest(gone[2], *[named(f"t{k}", "u") for k in (0, 1, 3)]), _cheapest(gone[3], named("t2", "a"))]


# A byte of a crc32: eight shifts, each with the fixed polynomial where the last bit is set.
_CRC_BYTE = "list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: xor(b >> 1, (b & 1) * 3988292384))"
_IMPOSSIBLE = "{'c': 1000000, 'a': ''}"
REPAIR_SQL = rf"""
    with recursive told as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(list_reduce(list_concat([4294967295::bigint],
               list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
               lambda x, y: {_CRC_BYTE}), 4294967295) % 20 as kind from conversations),
    rows as (
      select conv_id, turn, case when kind = 4 then 'user' else role end as role,
             case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
      from told, range(case kind when 0 then 0 when 3 then 2 else 1 end)),
    placed as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from rows),
    compared as (select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again from placed),
    facts as (
      select *, substr(role, 1, 1) as r, case when not regexp_matches(text, '[^ 	-
]') then 'b' when again then 'd'
               when regexp_matches(text, '[.!?][ 	-
]*\z') then '-' else 't' end as f,
             lag(substr(role, 1, 1)) over (partition by conv_id order by i) as p from compared),
    counted as (
      select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (f = 'b') as blank,
             count(*) filter (f = 'd') as duplicate, count(*) filter (f = 't') as truncated,
             count(*) filter (p is not null and p || r not in ('su', 'ua', 'au')) as illegal, count(*) as n from facts group by conv_id),
    ways(conv_id, i, n, s0, s1, s2, s3) as (
      select conv_id, 0::bigint, n, {{'c': 0, 'a': ''}}, {_IMPOSSIBLE}, {_IMPOSSIBLE}, {_IMPOSSIBLE} from counted
      union all
      select conv_id, i, n, {', '.join(_through())}
      from (select w.conv_id, w.i + 1 as i, w.n, x.f, x.r, {', '.join(f'{e} as t{k}' for k, e in enumerate(_closed('w.s0', 'w.s1', 'w.s2', 'w.s3')))}
            from ways w join facts x on x.conv_id is not distinct from w.conv_id and x.i = w.i + 1)),
    done as (select conv_id, {_cheapest('s0', _closed('s0', 's1', 's2', 's3')[3])} as best from ways where i = n),
    edits as (
      select conv_id, k, substr(best.a, k, 1) as e from done, unnest(range(1, len(best.a) + 1)) as u(k)),
    steps as (
      select *, sum((e <> 'I')::int) over (partition by conv_id order by k) as i,
             sum((e <> 'D')::int) over (partition by conv_id order by k) as o from edits),
    kept as (
      select s.conv_id, o, e, x.role, x.r, case when e = 'I' then '' else x.text end as text,
             first_value(e = 'K' and x.r = 's') over (partition by s.conv_id order by o) as led
      from steps s left join facts x on x.conv_id is not distinct from s.conv_id and x.i = s.i and e <> 'I' where e <> 'D'),
    written as (
      select conv_id, string_agg((case when e = 'K' then role when (o - led::int) % 2 = 1 then 'user' else 'assistant' end) || ':' || text,
                                 chr(10) order by o) as body from kept group by conv_id)
    select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.c, 0)::bigint as cost,
           coalesce(best.a, '') as audit, sha256(coalesce(body, '')) as repaired_sha256
    from (select distinct conv_id from conversations) c
    left join counted n on n.conv_id is not distinct from c.conv_id left join done d on d.conv_id is not distinct from c.conv_id
    left join written w on w.conv_id is not distinct from c.conv_id"""

# Kernel machines, token merges and measures, hash thresholds, graphs, packing and samples are not expressible in SQL;
# tests/llm compare those queries with brute force.
ORACLES: dict[str, str] = {
    "op9_minhash_near_dedup": r"""
    with w as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') as words from documents),
    s as (
      select doc_id, case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
        else list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) end as items
      from w),
    n as (select doc_id, len(items) as n from s),
    x as (select doc_id, unnest(items) as item from s),
    i as (select a.doc_id as a, b.doc_id as b, count(*) as shared from x a join x b on a.item = b.item and a.doc_id < b.doc_id group by 1, 2),
    links as materialized (
      select a, b from i join n p on p.doc_id = a join n q on q.doc_id = b where 100 * shared >= 85 * (p.n + q.n - shared)),
    edges as (select a, b from links union all select b, a from links),
    reach as (
      with recursive r(node, root) as (
        select doc_id, doc_id from n union select e.b, r.root from r join edges e on e.a = r.node)
      select node, min(root) as root from r group by 1)
    select n.doc_id, cast(n.n as bigint) as n_shingles, reach.root as component_id, reach.root = n.doc_id as kept
    from n join reach on reach.node = n.doc_id""",
    "op10_suffix_array_dedup": r"""
    with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    p as (select doc_id, unnest(range(0, len(h) // 2 - 199)) as pos, h from d where len(h) >= 400),
    g as (select doc_id, pos, md5(substr(h, 2 * pos + 1, 400)) as m from p),
    rep as (select m from g group by m having count(*) > 1),
    hit as (select doc_id, pos from g where m in (select m from rep)),
    o as (select doc_id, pos, pos - lag(pos) over (partition by doc_id order by pos) as gap from hit),
    run as (select doc_id, pos, sum(case when gap is null or gap > 200 then 1 else 0 end) over (partition by doc_id order by pos) as k from o),
    span as (select doc_id, k, min(pos) as b, max(pos) + 200 as e from run group by 1, 2),
    piece as (
      select doc_id, b, e, coalesce(lag(e) over (partition by doc_id order by b), 0) as f,
             lead(b) over (partition by doc_id order by b) is null as last from span),
    kept as (
      select doc_id, count(*) as n_spans, sum(e - b) as n_removed, max(e) as tail,
             string_agg(substr(h, 2 * f + 1, 2 * (b - f)), '' order by b) as k from piece join d using (doc_id) group by 1)
    select d.doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
           cast(coalesce(n_spans, 0) as bigint) as n_spans,
           sha256(unhex(coalesce(k || substr(h, 2 * tail + 1), h))) as kept_sha256
    from d left join kept using (doc_id)""",
    "op12_fill_in_middle": r"""
    with d as (select doc_id, coalesce(text, '') as text, sha256('7:' || doc_id) as h from documents),
    u as (
      select *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as units,
             [cast('0x' || substr(h, 1 + 8 * i, 8) as bigint) for i in range(4)] as r from d),
    c as (select *, cast(len(units) as bigint) as n, r[1] % (len(units) + 1) as a, r[2] % (len(units) + 1) as b from u),
    p as (
      select *, array_to_string(units[1 : least(a, b)], '') as pre, array_to_string(units[least(a, b) + 1 : greatest(a, b)], '') as mid,
             array_to_string(units[greatest(a, b) + 1 : ], '') as suf,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or r[3] % 100 >= 100
               then 'plain' when r[4] % 100 < 50 then 'spm' else 'psm' end as form from c)
    select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
           case when form <> 'plain' then length(mid) end as middle_chars,
           sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                  else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
           sha256(case form when 'plain' then text else pre || mid || suf end) as restored_sha256
    from p""",
    "op13_conversation_repair": REPAIR_SQL,
}
