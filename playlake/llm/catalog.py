"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm.common import shared_path, table
from playlake.llm.tokens import default_tokenizer


def op1_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.substring_dedup import remove_repeated_windows

    done = remove_repeated_windows(table(spark, sf_dir, "documents"), min_words=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op2_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as a token-id archive, then read the shard files back."""
    from playlake.llm.token_archive import read_archive, write_archive

    path = write_archive(table(spark, sf_dir, "documents"), shared_path(spark, "token-archive"),
                         default_tokenizer(), end_id=2)
    return read_archive(spark, path)


def op3_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.hash_index import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer(), size=2048, end_id=0)


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.slots import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=16)


def op6_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to a content-addressed archive, then read its records back."""
    from playlake.llm.warc import read_archive, write_archive

    path = write_archive(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_bitmask_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.langid import held_out, learn, predict

    docs = table(spark, sf_dir, "documents")
    filters = learn(docs.filter(~held_out()).select("text", "lang"))
    found = predict(docs.select("text", "doc_id", held_out().alias("held_out")), filters, ["doc_id", "held_out"])
    return found.select("carried.doc_id", "carried.held_out", "lang_pred", "score")


def op8_pca_tiled_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.embedding_dedup import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op9_vantage_point_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.simhash import near_duplicates, to_hex

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    return found.select("doc_id", to_hex("fp").alias("fingerprint"), "component_id")


def op10_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, decode the ids again, and digest both."""
    from playlake.llm.bpe import decode_documents, encode_documents

    path = default_tokenizer()
    done = decode_documents(encode_documents(table(spark, sf_dir, "documents"), path), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op11_drake_hamerly_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.vector_codes import books_sha256, compress

    done, books = compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return done.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def op12_template_markup_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.license_scan import license_report

    return license_report(table(spark, sf_dir, "documents")).drop("matches")


def op13_kd_tree_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.llm.spelling import frequent_words, noisy_words, spelling_variants

    words = noisy_words(table(spark, sf_dir, "documents"), every=97, min_letters=5)
    return spelling_variants(frequent_words(words, min_count=3), ratio=2)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_difference_cover_dedup": op1_difference_cover_dedup,
    "op2_token_archive": op2_token_archive,
    "op3_extendible_hash_dedup": op3_extendible_hash_dedup,
    "op4_sum_of_squares_packing": op4_sum_of_squares_packing,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_content_archive": op6_content_archive,
    "op7_bitmask_language_id": op7_bitmask_language_id,
    "op8_pca_tiled_dedup": op8_pca_tiled_dedup,
    "op9_vantage_point_simhash": op9_vantage_point_simhash,
    "op10_pair_index_bpe": op10_pair_index_bpe,
    "op11_drake_hamerly_codes": op11_drake_hamerly_codes,
    "op12_template_markup_licenses": op12_template_markup_licenses,
    "op13_kd_tree_spelling": op13_kd_tree_spelling,
}

OP1_SQL = """
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
starts as (
  select doc_id, w, unnest(range(1, len(w) - 18)) as s from words where len(w) >= 20),
windows as (
  select doc_id, s, array_to_string(w[s:s + 19], ' ') as t from starts),
repeats as (
  select doc_id, s from (
    select doc_id, s, row_number() over (partition by t order by doc_id, s) as k from windows) where k > 1),
gone as (
  select distinct doc_id, unnest(range(s, s + 20)) as i from repeats),
places as (
  select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from words),
kept as (
  select p.doc_id, string_agg(p.word, ' ' order by p.i) as t
  from places p anti join gone g on p.doc_id = g.doc_id and p.i = g.i group by p.doc_id),
removed as (select doc_id, count(*) as n from gone group by doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(r.n, 0) as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from words w left join kept k using (doc_id) left join removed r using (doc_id)
"""

OP3_SQL = """
with rows as (
  select doc_id, length(coalesce(text, '')) as n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm
  from documents)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by norm) as group_size,
       row_number() over w = 1 as kept,
       sha256(norm) as text_sha256
from rows
window w as (partition by norm order by n desc, doc_id)
"""

OP6_SQL = """
with rows as (
  select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as n from pages),
ranked as (
  select *, row_number() over (partition by payload order by page_id) as k,
         min(page_id) over (partition by payload) as first_id
  from rows)
select page_id, n as payload_bytes, sha256(payload) as payload_digest,
       case when n >= 100 and k > 1 then 'revisit' else 'response' end as record_type,
       case when n >= 100 and k > 1 then first_id end as refers_to
from ranked
"""

OP8_SQL = """
with recursive vectors as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings),
sound as (
  select * from vectors
  where label is not null and e is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and list_aggregate(list_transform(e, lambda x: abs(x)), 'max') > 0),
links as (
  select a.vec_id as u, b.vec_id as v
  from sound a join sound b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reached as (
  select vec_id, vec_id as to_id from vectors
  union
  select r.vec_id, l.v from reached r join links l on r.to_id = l.u),
roots as (select vec_id, min(to_id) as component_id from reached group by vec_id),
degrees as (select u as vec_id, count(*) as n from links group by u)
select r.vec_id, coalesce(d.n, 0) as n_links, r.component_id, r.vec_id = r.component_id as kept
from roots r left join degrees d using (vec_id)
"""

#: the nearest entry is the least of distance * 64 + index; a mean's floor is taken on whole numbers
_OP11_ASSIGN = """
a{r} as (
  select vec_id, label, p, x, m % 64 as e, m // 64 as d from (
    select k.vec_id, k.label, k.p, any_value(k.x) as x, min(
      list_sum(list_transform(list_zip(k.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + c.e)::hugeint as m
    from pieces k join b{r} c using (p) group by k.vec_id, k.label, k.p))"""
_OP11_MOVE = """
n{r} as (
  select p, e, i, sum(v)::hugeint as s, count(*)::hugeint as n from (
    select p, e, generate_subscripts(x, 1) as i, unnest(x) as v from a{r}) group by p, e, i),
f{r} as (
  select p, e, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from n{r} group by p, e),
b{s} as (
  select b.p, b.e, coalesce(f.c, b.c) as c from b{r} b left join f{r} f using (p, e))"""
OP11_SQL = """
with ints as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
pieces as materialized (
  select vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] as x
  from ints, range(16) t(p)),
b0 as (
  select p, x as c, rank_ - 1 as e from pieces
  join (select vec_id, row_number() over (order by vec_id) as rank_ from ints) using (vec_id) where rank_ <= 64),
""" + ",".join([_OP11_ASSIGN.format(r=0), _OP11_MOVE.format(r=0, s=1), _OP11_ASSIGN.format(r=1),
                _OP11_MOVE.format(r=1, s=2), _OP11_ASSIGN.format(r=2)]) + """,
codes as (
  select vec_id, label, string_agg(format('{:02x}', e::bigint), '' order by p) as code, sum(d)::bigint as error
  from a2 group by vec_id, label),
digest as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from b2)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from codes, digest
"""



def _op12_sql() -> str:
    """Phrases by comparing words place by place, templates as regular expressions over the joined words."""
    from playlake.llm.license_scan import PHRASES, TEMPLATES, as_regex, mandatory_words

    places = " union all ".join(
        f"select doc_id, s, '{t.label}' as label, {len(t.markup.split())} as size "
        f"from (select doc_id, w, unnest(range(len(w))) as s from words) "
        f"where w[s + 1:s + {len(t.markup.split())}] = {t.markup.split()!r}" for t in PHRASES)
    accepted = " union all ".join(
        f"select doc_id, '{t.label}' as label, {mandatory_words(t.markup)} as size from joined "
        f"where regexp_matches(t, '{as_regex(t.markup)}')" for t in TEMPLATES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with words as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
joined as materialized (select doc_id, ' ' || array_to_string(w, ' ') || ' ' as t from words),
places as materialized ({places}),
accepted as materialized ({accepted}),
base as (
  select doc_id, count(*) as n, min(s) as first_word, max(s) as last_word,
         string_agg(distinct label, ',' order by label) as labels
  from places group by doc_id),
both_ as (select doc_id, label, size from places union all select doc_id, label, size from accepted),
every as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels, max(size) as size
  from both_ group by doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(b.n, 0) as n_base, b.first_word, b.last_word,
       coalesce(b.labels, '') as base_labels, coalesce(e.labels, '') as labels,
       coalesce(e.size / len(w.w), 0)::double as score
from words w left join base b using (doc_id) left join every e using (doc_id)
"""


def _op13_sql() -> str:
    """CRC-32 byte by byte over a table made by its rule; near words through patterns with one letter left out."""
    crc = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 * (c & 1))
        crc.append(c)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with recursive crc as materialized (select {crc}::bigint[] as t),
runs as materialized (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                             '[a-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents)
  where length(run) >= 5 group by doc_id, run),
hashed as materialized (
  select run, n, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(0, strlen(hex(k)) // 2),
        lambda i: ('0x' || hex(k)[2 * i + 1:2 * i + 2])::bigint)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h
  from (select run, n, encode(coalesce(doc_id::varchar, '') || ':' || run) as k from runs), crc),
words as materialized (
  select word, sum(n)::bigint as n from (
    select n, case when h % 97 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
                   else run end as word from hashed)
  where length(word) >= 5 group by word having sum(n) >= 3),
cut as materialized (
  select word, i, left(word, i - 1) as head, substr(word, i + 1) as tail
  from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as materialized (
  select a.word, b.word as other from cut a join cut b on a.head = b.head and a.tail = b.tail and a.word <> b.word
  union select w.word, c.word from cut c join words w on w.word = c.head || c.tail
  union select c.word, w.word from cut c join words w on w.word = c.head || c.tail),
ranked as (
  select r.word, r.other, o.n as other_n, count(*) over (partition by r.word) as n_near,
         row_number() over (partition by r.word order by o.n desc, r.other) as k
  from near r join words o on o.word = r.other),
forms as materialized (
  select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when r.other_n >= 2 * w.n then r.other end as form,
         case when r.other_n >= 2 * w.n then r.other_n end as form_n
  from words w left join ranked r on r.word = w.word and r.k = 1),
chain as (
  select word, word as root, form as further from forms
  union all
  select c.word, f.word, f.form from chain c join forms f on f.word = c.further)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n
from forms f join chain c on c.word = f.word and c.further is null
"""


LLM_ORACLE_SQL: dict[str, str] = {
    "op1_difference_cover_dedup": OP1_SQL,
    "op3_extendible_hash_dedup": OP3_SQL,
    "op6_content_archive": OP6_SQL,
    "op8_pca_tiled_dedup": OP8_SQL,
    "op11_drake_hamerly_codes": OP11_SQL,
    "op12_template_markup_licenses": _op12_sql(),
    "op13_kd_tree_spelling": _op13_sql(),
}
