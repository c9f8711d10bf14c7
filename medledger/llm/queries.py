"""Registered queries of the operators: the real outputs, and the digest columns derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medledger.llm import audit, bpe, hmm, matrices, packing, quantised, ranked, secrets, sentencebpe, simhash, toolchat, topk, toxicity
from medledger.llm.common import fold_of, read_table


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold_of("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_quantised_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(read_table(spark, sf_dir, "documents"), hmm.held_out("doc_id"))


def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode_documents(bpe.encode_documents(read_table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: The tools of the derived calls.
TOOLS = """
    select * from values
        ('count', 'limit', 'integer', true), ('count', 'text', 'string', false), ('count', 'ref', 'string', false),
        ('search', 'limit', 'number', true), ('search', 'text', 'string', true), ('search', 'ref', 'string', false),
        ('translate', 'text', 'string', true), ('translate', 'ref', 'string', false)
    as t(tool, param, type, required)
"""


def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = toolchat.with_calls(read_table(spark, sf_dir, "conversations"))
    return toolchat.linked_chats(chats, spark.sql(TOOLS))


def op8_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_credential_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = secrets.scan_secrets(docs, secrets.fit(docs))
    said = F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(said, lambda x: ~x.startswith("format:"))
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(said, ",").alias("spans"),
    )


def op10_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = matrices.packed_matrices(read_table(spark, sf_dir, "documents"))
    return packed.select(
        "sequence_id",
        "n_tokens",
        F.crc32("input_ids").alias("ids_crc32"),
        F.crc32("position_ids").alias("positions_crc32"),
        "cu_seqlens",
        "doc_ids",
        "starts",
    )


def op11_survival_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_serialised_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencebpe.decode_documents(sentencebpe.encode_documents(read_table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compression_toxicity,
        op2_sum_of_squares_packing,
        op3_quantised_duplicates,
        op4_hidden_markov,
        op5_bpe_transducer,
        op6_simhash_variants,
        op7_tool_call_linking,
        op8_segment_topk,
        op9_credential_automata,
        op10_packed_matrices,
        op11_survival_words,
        op12_hybrid_search,
        op13_serialised_bpe,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op7_tool_call_linking": """
        with calls as (
            select *, ['count', 'search', 'translate'][length(text) % 3 + 1] as tool, length(text) as n,
                (turn // 2) % 2 = 0 and length(text) % 13 < 6 as forward
            from conversations where role = 'assistant' and text is not null and turn is not null
        ), answers as (
            select conv_id, turn, 'c' || (turn - 1) as call_id, to_json(text)::varchar as content
            from conversations where role = 'user' and turn >= 1 and text is not null
        ), first_answers as (
            select conv_id, call_id, min(content) as result from answers group by all
        ), known as (
            select distinct conv_id, turn from calls
        ), told as (
            select c.conv_id, c.turn, tool, result, c.forward and k.turn is not null as moved,
                '{' || concat_ws(',',
                    case when n % 11 = 0 then '"extra":true' end,
                    '"limit":' || case when n % 5 = 0 then '"many"' else n::varchar end,
                    case when c.forward then '"ref":"$result:c' || (c.turn + 2) || '"' end,
                    case when n % 7 <> 0 then '"text":' || to_json(text)::varchar end) || '}' as arguments,
                '[' || concat_ws(',',
                    case when n % 7 = 0 and tool <> 'count' then '"missing text"' end,
                    case when n % 5 = 0 and tool = 'count' then '"not integer limit"' end,
                    case when n % 5 = 0 and tool = 'search' then '"not number limit"' end,
                    case when n % 11 = 0 then '"unknown extra"' end,
                    case when tool = 'translate' then '"unknown limit"' end) || ']' as errors
            from calls c
            left join first_answers a on a.conv_id = c.conv_id and a.call_id = 'c' || c.turn
            left join known k on k.conv_id = c.conv_id and k.turn = c.turn + 2
        )
        select conv_id, turn + case when moved then 2 else 0 end as order_turn, moved::bigint as order_step, turn,
            1 as part, case when result is null then 'open' else 'linked' end as status,
            '{"arguments":' || arguments || ',"errors":' || errors || ',"id":"c' || turn || '","name":"' || tool
                || '","result":' || coalesce(result, 'null') || '}' as message
        from told
        union all
        select conv_id, turn, 0, turn, 0, 'message', '{"content":' || coalesce(to_json(text)::varchar, 'null')
            || ',"role":' || coalesce(to_json(role)::varchar, 'null') || '}'
        from conversations
        union all
        select a.conv_id, a.turn, 0, a.turn, 0, 'orphan',
            '{"content":' || content || ',"id":"' || call_id || '","role":"tool"}'
        from answers a where not exists (select 1 from known k where k.conv_id = a.conv_id and 'c' || k.turn = a.call_id)
    """,
    "op8_segment_topk": """
        with whole as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
            from whole q join whole c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
        )
        select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as "rank",
            vec_id, score
        from scored qualify "rank" <= 5
    """,
    "op11_survival_words": r"""
        with recursive texts as (
            select doc_id, coalesce(source, '') as part, coalesce("text", '') as t,
                regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as words
            from documents
        ), failed as (
            select doc_id, part, (len(words) < 50)::int
                + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
                + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int
                + 8 * regexp_matches(t, '[#$%&*|]')::int
                + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as fails
            from texts
        ), marks as (
            select doc_id, coalesce(max((quality = 1)::int), 0) as good, coalesce(max((toxic = 1)::int), 0) as toxic
            from labels group by doc_id
        ), cells as (
            select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
            from failed left join marks on marks.doc_id = failed.doc_id group by part, fails
        ), orders as (
            select '' as filter_order
            union all
            select filter_order || letter from orders, unnest(['A', 'B', 'C', 'D', 'E']) as l(letter)
            where not contains(filter_order, letter)
        ), steps as (
            select filter_order, step, 1 << (ascii(filter_order[step]) - 65) as bit,
                list_sum([1 << (ascii(filter_order[i]) - 65) for i in range(1, step + 1)])::int as later
            from orders, range(1, 6) as s(step) where length(filter_order) = 5
        ), told as (
            select part, filter_order, step, bit,
                sum(n) filter (where fails & later = 0) as kept,
                sum(n) filter (where fails & later = bit) as removed,
                sum(n) filter (where fails & bit > 0 and fails & later <> bit) as redundant,
                sum(n) filter (where fails = bit) as unique_fails,
                sum(good) filter (where fails & later = bit) as good_lost,
                sum(toxic) filter (where fails & later = bit) as toxic_lost
            from cells, steps group by all
        )
        select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept,
            coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
            coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
            coalesce(toxic_lost, 0)::bigint as toxic_lost,
            coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley
        from told
    """,
    "op12_hybrid_search": r"""
        with doc_terms as (
            select doc_id, unnest(regexp_extract_all(
                translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents
        ), item_terms as (
            select item_id, unnest(regexp_extract_all(
                translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ), sizes as (
            select doc_id, count(*) as n from doc_terms group by doc_id
        ), total as (
            select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from sizes
        ), postings as (
            select doc_id, term, count(*)::bigint as tf from doc_terms
            where term in (select term from item_terms) group by all
        ), weights as (
            select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
            from postings, total group by term
        ), scored as (
            select item_id, doc_id,
                sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint as score
            from (select item_id, term, count(*)::bigint as times from item_terms group by all) asked
            join postings using (term) join weights using (term) join sizes using (doc_id), total
            group by item_id, doc_id
        )
        select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as "rank", doc_id, score
        from scored where score > 0 qualify "rank" <= 10
    """,
}
