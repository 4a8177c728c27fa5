"""The operators as registered queries over the given tables, and SQL counterparts where SQL has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import bpe, decontaminate, fingerprint, html_template, jaccard_join, lm_trie, personal_data, phrases, reply_trees, sentence_piece, token_count, toxicity, turn_repair


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(spark, _table(spark, sf_dir, "documents"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_trie.score_documents(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(_table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(_table(spark, sf_dir, "pages"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.span_digests(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), model or _vocabulary("piece_bpe_32k.model"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary or _vocabulary("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


#: Conversation -7 of op10: both turns say what looks like control strings.
ODD_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string")
    return reply_trees.conversation_digests(given.unionByName(odd))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_sentence_piece_round_trip(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    return sentence_piece.round_trip(_table(spark, sf_dir, "documents"), model or _vocabulary("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_lm_scores,
        op3_ngram_jaccard_join,
        op4_benchmark_decontamination,
        op5_html_extraction,
        op6_personal_data,
        op7_token_counts,
        op8_bpe_round_trip,
        op9_toxicity,
        op10_chat_formatting,
        op11_conversation_repair,
        op12_phrase_collocations,
        op13_sentence_piece_round_trip,
    )
}


def _escaped(text: str) -> str:
    """SQL for a text with its backslashes doubled and its control strings broken."""
    sql = f"replace({text}, chr(92), chr(92) || chr(92))"
    for control in reply_trees.CONTROL:
        sql = f"replace({sql}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return sql


def _shingled(table: str, key: str) -> str:
    """SQL for the distinct five-word shingles of a table's texts."""
    return f"""
        select distinct {key}, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as shingle
        from (select {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as w from {table}) where len(w) >= 5
    """


LEAKS_SQL = f"""
    select doc_id, item_id, count(*)::bigint as shared, max(n)::bigint as n_item, count(*)::double / max(n) as containment
    from ({_shingled("documents", "doc_id")}) d
    join ({_shingled("benchmark", "item_id")}) i using (shingle)
    join (select item_id, count(*) as n from ({_shingled("benchmark", "item_id")}) group by item_id) using (item_id)
    group by doc_id, item_id having count(*) >= ceil(max(n) * 0.8 - 1e-9)
    union all
    select distinct doc_id, item_id, 1::bigint, 1::bigint, 1::double
    from (select doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), ' ') || ' ' as held from documents) d
    join (select item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as w from benchmark) i
      on len(i.w) between 1 and 4 and contains(d.held, ' ' || array_to_string(i.w, ' ') || ' ')
"""

#: crc32 of an ASCII text, a bit at a time: the first of each byte's eight steps takes the byte in.
CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, flatten(list_transform(range(1, len({s}) + 1), lambda i: list_prepend(ord({s}[i])::bigint, [0, 0, 0, 0, 0, 0, 0]::bigint[])))),
        lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))))"""

#: Rows are read one by one: the cheapest edits for each last role so far, with up to two rows put in before each.
REPAIR_SQL = f"""
    with recursive given as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as said
        from conversations
    ), fated as (
        select *, {CRC32.format(s="said")} % 20 as fate from given
    ), hurt as (
        select conv_id, turn, case when fate = 4 then 'user' else role end as role,
               case fate when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
        from fated, range(0, 2) as copies(copy) where fate <> 0 and (copy = 0 or fate = 3)
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as place,
               rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as trimmed
        from hurt
    ), coded as (
        select *, role[1:1] as initial, count(*) over (partition by conv_id) as n,
               lag(role[1:1]) over (partition by conv_id order by place) as before,
               row_number() over (partition by conv_id, role, text order by place) > 1 as again,
               case when trimmed = '' then 'blank' when again then 'duplicate' when trimmed[-1:] not in ('.', '!', '?') then 'truncated' else '' end as fault
        from placed
    ), moves as (
        select * from (values ('', 'u', 1), ('', 'a', 2), ('s', 'u', 1), ('s', 'a', 2), ('u', 'a', 1), ('a', 'u', 1), ('u', 'u', 2), ('a', 'a', 2)) t(p, q, puts)
        union all select * from (values ('', '', 0), ('s', 's', 0), ('u', 'u', 0), ('a', 'a', 0)) t(p, q, puts)
    ), steps as (
        select c.conv_id, c.place, e.p, e.q, e.edit, e.cost + case when fault = 'truncated' and e.edit <> 'D' then 1 else 0 end as cost
        from coded c, (
            select p, p as q, 'D' as edit, 3 as cost from (values (''), ('s'), ('u'), ('a')) t(p)
            union all select p, q, edit, case edit when 'K' then 0 else 2 end
            from (values ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')) t(p, q), (values ('K'), ('R')) k(edit)
            union all select '', 's', 'K', 0
        ) e
        where (e.edit = 'D' or c.fault not in ('blank', 'duplicate')) and (e.edit <> 'K' or c.initial = e.q)
    ), walk as (
        select distinct conv_id, 0::bigint as place, '' as st, 0::bigint as cost, '' as audit from coded
        union all
        select conv_id, place, st, unnest(least_cell, recursive := true) from (
            select w.conv_id, w.place + 1 as place, s.q as st,
                   min({{'cost': (w.cost + 2 * m.puts + s.cost)::bigint, 'audit': w.audit || repeat('I', m.puts) || s.edit}}) as least_cell
            from walk w join moves m on m.p = w.st join steps s on s.conv_id is not distinct from w.conv_id and s.place = w.place + 1 and s.p = m.q
            group by all
        )
    ), ended as (
        select w.conv_id, min({{'cost': (w.cost + 2 * m.puts)::bigint, 'audit': w.audit || repeat('I', m.puts)}}) as best
        from walk w join moves m on m.p = w.st join (select distinct conv_id, n from coded) c on c.conv_id is not distinct from w.conv_id and c.n = w.place
        where m.q = 'a' or (m.q = '' and w.st = '') group by w.conv_id
    ), edits as (
        select conv_id, best.audit as audit, i, best.audit[i:i] as edit, (length(best.audit) - length(replace(best.audit, 'D', ''))) as dropped
        from ended, unnest(range(1, length(best.audit) + 1)) as t(i)
    ), numbered as (
        select *, sum(case when edit <> 'D' then 1 else 0 end) over (partition by conv_id order by i) - 1 as slot,
               sum(case when edit <> 'I' then 1 else 0 end) over (partition by conv_id order by i) as place
        from edits
    ), lines as (
        select x.conv_id, x.i,
               case when edit = 'K' then c.role when (slot + (length(audit) - dropped)) % 2 = 0 then 'user' else 'assistant' end
               || ':' || case when edit = 'I' then '' else c.text end as line
        from numbered x left join coded c on c.conv_id is not distinct from x.conv_id and c.place = x.place and x.edit <> 'I'
        where edit <> 'D'
    ), said as (
        select conv_id, string_agg(line, chr(10) order by i) as whole from lines group by conv_id
    ), counted as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 'blank') as blank,
               count_if(fault = 'duplicate') as duplicate, count_if(fault = 'truncated') as truncated,
               count_if(place > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
        from coded group by conv_id
    )
    select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
           coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
           coalesce(best.cost, 0)::bigint as cost, coalesce(best.audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
    from (select distinct conv_id from conversations) i
    left join counted c on c.conv_id is not distinct from i.conv_id
    left join ended e on e.conv_id is not distinct from i.conv_id
    left join said d on d.conv_id is not distinct from i.conv_id
"""

PHRASES_SQL = """
    with pieces as (
        select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents
    ), words as (
        select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
    ), counted as (
        select lang, phrase, count(*) as f from (
            select lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda n: list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: w[i:i+n-1])))) as phrase from words
        ) group by all
    ), totals as (
        select lang, sum(f) as n from counted where len(phrase) = 1 group by lang
    ), frequent as (
        select * from counted where f >= 30 and len(phrase) > 1
    ), cuts as (
        select c.lang, c.phrase, c.f as a, k, l.f as l, r.f as r, (2000000::hugeint * c.f) // (l.f + r.f) as score
        from (select *, unnest(range(1, len(phrase))) as k from frequent) c
        join counted l on l.lang = c.lang and l.phrase = c.phrase[1:k]
        join counted r on r.lang = c.lang and r.phrase = c.phrase[k+1:]
    ), lowest as (
        select lang, phrase, a, l, r, score from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
    ), inner_phrases as (
        select lang, unnest(flatten(list_transform(range(2, len(phrase)), lambda n: list_transform(range(1, len(phrase) - n + 2), lambda i: phrase[i:i+n-1])))) as phrase, f
        from frequent where len(phrase) > 2
    ), longer as (
        select lang, phrase, max(f) as longer from inner_phrases group by all
    ), kept as (
        select b.lang, array_to_string(b.phrase, ' ') as phrase, a, l, r, score
        from lowest b left join longer g on g.lang = b.lang and g.phrase = b.phrase
        where g.longer is null or 100::hugeint * g.longer < 80::hugeint * a
    )
    select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from (
        select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
    ) join totals using (lang) where rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op12_phrase_collocations": PHRASES_SQL,
    "op11_conversation_repair": REPAIR_SQL,
    "op4_benchmark_decontamination": LEAKS_SQL,
    "op10_chat_formatting": f"""
        with given as (
            select conv_id, turn, role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        select conv_id,
               count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
               sum(length('<s>' || role || chr(10) || {_escaped("text")} || '</s>'))::bigint as formatted_chars
        from given group by conv_id
    """,
}
