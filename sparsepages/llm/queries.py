"""One query per operator, with production parameters, over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import aligned
from .common import scratch, table
from .decontaminate import contaminated_words
from .fingerprints import edited_fingerprints
from .lines import line_report
from .mixing import mix
from .neardup import near_duplicates
from .phrases import collocations
from .pii import pseudonymised
from .sentencepieces import piece_digests
from .substrings import repeated_passages
from .tokencounts import count_tokens
from .tokenfile import read_tokens, write_tokens
from .toxicity import score, train
from .vocab import vocabulary


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, weight``: labelled good 2, bad 0.5; documents without a label weigh 1."""
    marks = table(spark, sf_dir, "labels").filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return marks.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10).drop("text_hash")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("text_hash")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("doc")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), path)
    return read_tokens(spark, path)


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymised(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.size("pii").cast("bigint").alias("n_entities"), "pii", "text")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_toxicity,
        op2_decontamination,
        op3_source_mixing,
        op4_minhash_neardup,
        op5_line_dedup,
        op6_substring_dedup,
        op7_fingerprints,
        op8_token_output,
        op9_pii_surrogates,
        op10_token_counts,
        op11_phrases,
        op12_token_alignment,
        op13_sentencepiece,
    )
    return {f.__name__: f for f in every}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; the others are tested against plain versions."""
    return {
        "op2_decontamination": f"""
            with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
            b as (select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
            win as (
                select distinct item_id, w[i : i + 9] as win
                from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
            ),
            cut as (
                select doc_id, i, n, w[i : i + n - 1] as win
                from (
                    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
                    from d, (select distinct len(win) as n from win) where len(w) >= n
                )
            ),
            hit as (select doc_id, i, n, item_id from cut join win using (win)),
            place as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
            item as (
                select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
                from (select distinct doc_id, item_id::varchar as id from hit) group by doc_id
            )
            select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
                   sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
            from d left join place using (doc_id) left join item using (doc_id)""",
        "op4_minhash_neardup": f"""
            with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
            s as (
                select distinct doc_id, w[i : i + 2] as s
                from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from w where len(w) > 0)
            ),
            n as (select doc_id, count(*) as n from s group by doc_id),
            links as (
                select x.doc_id as a, y.doc_id as b
                from s x join s y using (s) join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
                group by x.doc_id, y.doc_id, nx.n, ny.n
                having 100 * count(*) >= 85 * (nx.n + ny.n - count(*))
            ),
            reached as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
            least as (select a as doc_id, min(b) as component_id from reached group by a)
            select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id,
                   coalesce(component_id, doc_id) = doc_id as kept
            from documents left join n using (doc_id) left join least using (doc_id)""",
        "op11_phrases": f"""
            with piece as (
                select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER.replace("text", "coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) as piece
                from documents
            ),
            w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from piece),
            g as (
                select lang, w[i : i + k - 1] as g
                from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest(range(1, 6)) as k) where len(w) >= k)
            ),
            f as (select lang, g, len(g) as k, count(*) as f from g group by lang, g),
            size as (select lang, sum(f) as n from f where k = 1 group by lang),
            c as (select * from f where k > 1 and f >= 100),
            cut as (select lang, g, k, f as a, unnest(range(1, k)) as j from c),
            rated as (
                select cut.lang, cut.g, a, l.f as l, r.f as r, n::bigint as n, j, (1000::hugeint * a * n::hugeint) // (l.f::hugeint * r.f) as score
                from cut join size using (lang)
                join f l on l.lang = cut.lang and l.g = cut.g[1:j] join f r on r.lang = cut.lang and r.g = cut.g[j + 1 :]
            ),
            best as (select * from rated qualify row_number() over (partition by lang, g order by score, j) = 1),
            part as (
                select lang, f, g[i : i + m - 1] as g
                from (select *, unnest(range(1, k - i + 2)) as m from (select *, unnest(range(1, k + 1)) as i from c)) where m < k
            ),
            longer as (select lang, g, max(f) as f from part group by lang, g),
            kept as (
                select best.*, array_to_string(g, ' ') as phrase from best left join longer using (lang, g) where coalesce(longer.f, 0) < a
            )
            select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
            from kept qualify rank <= 2000""",
    }
