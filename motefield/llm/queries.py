"""The registered queries of this subpackage and their check statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, cosine, jaccard, language, lengths, likelihood, maxscore, mixing, pieces, preferences, repeats,
               spelling, tokens)

QUERIES: dict = {}
CHECKS: dict = {}


def query(name: str, check: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = f"regexp_extract_all(coalesce(text, ''), '{PATTERN}')"


@query("op2_substring_dedup", f"""
    with w as (select cast(doc_id as bigint) doc_id, {WORDS} ws from documents),
    g as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') win from (select doc_id, ws, unnest(range(1, len(ws) - 11)) i from w)),
    least as (select win, min(doc_id) m from g group by win),
    gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 13)) p from g join least using (win) where m < doc_id)),
    n as (select doc_id, count(*) n from gone group by doc_id),
    kept as (select t.doc_id, string_agg(t.x, ' ' order by t.p) s from (select doc_id, unnest(ws) x, unnest(range(1, len(ws) + 1)) p from w) t
             left join gone g on g.doc_id = t.doc_id and g.p = t.p where g.p is null group by t.doc_id)
    select w.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n.n, 0) as bigint) n_removed, sha256(coalesce(s, '')) kept_sha256
    from w left join n using (doc_id) left join kept using (doc_id)""")
def op2(spark, sf_dir):
    return repeats.repeat_digest(documents(spark, sf_dir))


@query("op6_ngram_jaccard_join", f"""
    with w as (select cast(doc_id as bigint) doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{PATTERN}') ws from documents),
    s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') g from (select doc_id, ws, unnest(range(1, len(ws) - 3)) i from w where len(ws) >= 5)
          union all select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and 4),
    n as (select doc_id, count(*) n from s group by doc_id),
    c as (select doc_id, n, bit_xor(hash(g)) h, min(g) lo, max(g) hi from s join n using (doc_id) group by doc_id, n),
    lead as (select n, h, lo, hi, min(doc_id) rep from c group by n, h, lo, hi),
    rep as (select c.doc_id, rep from c join lead using (n, h, lo, hi)),
    few as (select g from s join rep using (doc_id) where doc_id = rep group by g having count(*) > 1),
    o as (select a.doc_id x, b.doc_id y, count(*) o from s a join few using (g) join rep ra on ra.doc_id = a.doc_id and ra.rep = a.doc_id
          join s b using (g) join rep rb on rb.doc_id = b.doc_id and rb.rep = b.doc_id where a.doc_id < b.doc_id group by 1, 2),
    links as (select x, y from o join n a on a.doc_id = x join n b on b.doc_id = y where 100 * o >= 75 * (a.n + b.n - o)
              union select rep, doc_id from rep where rep <> doc_id),
    bi as (select x, y from links union select y, x from links),
    reach as (with recursive r(a, b) as (select x, x from bi union select r.a, bi.y from r join bi on bi.x = r.b) select a doc_id, min(b) m from r group by a)
    select w.doc_id, cast(coalesce(n.n, 0) as bigint) n_shingles, coalesce(m, w.doc_id) component_id from w left join n using (doc_id) left join reach using (doc_id)""")
def op6(spark, sf_dir):
    return jaccard.near_components(documents(spark, sf_dir))


@query("op1_language_id")
def op1(spark, sf_dir):
    return language.identify(documents(spark, sf_dir))


@query("op3_maxscore_topk", """
    with v as (select distinct cast(vec_id as bigint) id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e from embeddings
               where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.id query_id, c.id vec_id, cast(list_inner_product(q.e, c.e) as bigint) score from v q join v c on q.id <> c.id where q.id % 50 = 0)
    select query_id, cast(rank as integer) rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 5""")
def op3(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return maxscore.search(vectors, vectors.where("vec_id % 50 = 0"))


@query("op4_pfair_mix")
def op4(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


@query("op5_lattice_lm")
def op5(spark, sf_dir):
    return likelihood.score(documents(spark, sf_dir))


@query("op7_preference_pairs", """
    with t as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) n
               from (select distinct conv_id, turn, role, text from conversations where conv_id is not null)),
    l as (select conv_id, max(n) filter (role = 'assistant') last, count(*) n from t group by conv_id),
    r as (select xor(conv_id, 1) conv_id, role, text from t join l using (conv_id) where t.n = last),
    m as (select t.*, last, r.conv_id is not null has, r.text other,
                 last is not null and not (r.conv_id is not null and t.n = last and r.text is not distinct from t.text) as open,
                 '<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10) shown
          from t join l using (conv_id) left join r using (conv_id) where last is null or t.n <= last),
    p as (select conv_id, string_agg(shown, '' order by n) filter (last is null or n < last or not open) prompt,
                 count(*) filter (last is null or n < last or not open) prompt_turns,
                 string_agg(shown, '') filter (n = last and open) chosen_text,
                 max(length(coalesce(text, ''))) filter (n = last and open) chars,
                 max(coalesce(other, '')) filter (n = last and open and has) reply
          from m group by conv_id)
    select conv_id, cast(prompt_turns as integer) prompt_turns, coalesce(prompt, '') prompt, coalesce(chosen_text, '') chosen_text,
           coalesce('14-' || (14 + chars + 8), '') chosen_spans,
           coalesce('<|assistant|>' || chr(10) || reply || '<|end|>' || chr(10), '') rejected_text,
           coalesce('14-' || (14 + length(reply) + 8), '') rejected_spans from p""")
def op7(spark, sf_dir):
    pairs = preferences.format_pairs(preferences.swapped_replies(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    told = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), " ").alias(c)
    return pairs.select("conv_id", "prompt_turns", "prompt", "chosen_text", told("chosen_spans"), "rejected_text", told("rejected_spans"))


@query("op8_length_buckets")
def op8(spark, sf_dir):
    return lengths.batch(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


@query("op9_packed_rows")
def op9(spark, sf_dir):
    return tokens.pack_documents(documents(spark, sf_dir))


@query("op10_embedding_near_dedup", """
    with v as (select cast(vec_id as bigint) id, label, list_transform(embedding, lambda x: cast(x as double)) e from embeddings
               where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                     and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    bi as (select a.id x, b.id y from v a join v b on a.label = b.label and a.id <> b.id where list_cosine_similarity(a.e, b.e) >= 0.98),
    reach as (with recursive r(a, b) as (select distinct x, x from bi union select r.a, bi.y from r join bi on bi.x = r.b) select a vec_id, min(b) m from r group by a),
    n as (select x vec_id, count(*) n from bi group by x)
    select cast(e.vec_id as bigint) vec_id, cast(coalesce(n, 0) as bigint) n_links, coalesce(m, e.vec_id) component_id, coalesce(m, e.vec_id) = e.vec_id kept
    from embeddings e left join n using (vec_id) left join reach using (vec_id)""")
def op10(spark, sf_dir):
    return cosine.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op11_token_alignment")
def op11(spark, sf_dir):
    return alignment.alignment_digest(documents(spark, sf_dir))


@query("op12_piece_codec")
def op12(spark, sf_dir):
    return pieces.codec_digest(documents(spark, sf_dir))


@query("op13_spelling_variants", """
    with recursive crc as (select list(c order by i) t from (select i, list_reduce([i] || range(8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c
                                                   from (select unnest(range(256)) i))),
    runs as (select cast(doc_id as bigint) doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) run from documents),
    r as (select coalesce(cast(doc_id as varchar), '') id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run, count(*) n
          from runs where length(run) >= 6 group by all),
    b as (select run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)]
                                     else [192 + unicode(c) // 64, 128 + unicode(c) % 64] end)) bytes from r),
    h as (select run, n, xor(list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) h from b, crc),
    w as (select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, n from h),
    v as (select word, cast(sum(n) as bigint) n from w where length(word) >= 6 group by word having sum(n) >= 5),
    e as (select word, n, translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~') one from v),
    near as (select x.word, x.n, y.word near, y.n near_n from e x join e y on abs(length(x.one) - length(y.one)) <= 1 and x.word <> y.word
             where levenshtein(x.one, y.one) = 1),
    f as (select word, count(*) n_near, first(near order by near_n desc, near) best, max(near_n) best_n from near group by word),
    told as (select v.word, v.n, coalesce(n_near, 0) n_near, case when best_n >= 5 * v.n then best end form, case when best_n >= 5 * v.n then best_n end form_n
             from v left join f using (word)),
    walk as (select word, word place, 0 steps from told union all select walk.word, told.form, steps + 1 from walk join told on told.word = walk.place where told.form is not null)
    select told.word, form, root, told.n, n_near, form_n from told join (select word, arg_max(place, steps) root from walk group by word) using (word)""")
def op13(spark, sf_dir):
    return spelling.variants(documents(spark, sf_dir))
