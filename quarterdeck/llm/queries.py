"""The registered queries of this subpackage, and SQL that gives the same rows where SQL can.

Each query applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import functions as F

from quarterdeck.llm import decontam, language, lines, native, near_dup, order_minhash, pieces, runs, suffix_dedup, token_counts, url_filter, vector_codes, warc, window_dedup
from quarterdeck.llm.hot import join_by_weight
from quarterdeck.plans.shapes import table
from quarterdeck.session import materialize, scratch_path

WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def n_bytes(text: str = "text"):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def op1_suffix_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeated_bytes(docs).select("doc_id", "removed.*")
    return done.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256")


def op2_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, tokenizer_file(WORD_BPE))
    return counted.select("doc_id", n_bytes().alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op3_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontam.contaminated(docs, table(spark, sf, "benchmark"))


def op5_window_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return window_dedup.remove_repeated_words(docs).select("doc_id", "removed.n_words", "removed.n_removed", "removed.kept_sha256")


def op6_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.remove_repeated_lines(docs).select("doc_id", "lines.n_lines", "lines.n_removed", "lines.kept_sha256")


def op7_near_dup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return near_dup.components(docs, words=3, similarity=Fraction(85, 100)).drop("set_key")


def op8_order_minhash(spark, sf):
    return order_minhash.fingerprints(table(spark, sf, "documents").select("doc_id", "text"))


def op9_sentence_pieces(spark, sf):
    path = tokenizer_file(PIECES)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    both = pieces.encode(docs, path, decoded="decoded")
    return both.select(
        "doc_id",
        n_bytes().alias("n_bytes"),
        F.size("ids").cast("long").alias("n_pieces"),
        pieces.fallback_count(F.col("ids"), path).alias("n_byte_pieces"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op10_language(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    known = F.coalesce(held_out(), F.lit(False))
    model = language.fit(docs, ~known)
    predicted = language.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", known.alias("held_out"), "lang_pred", "score")


def op11_vector_codes(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.fit(rows)
    coded = materialize(vector_codes.encode(rows, books).where("code is not null").drop("embedding"), "codes")
    labels = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n"))
    return join_by_weight(coded, labels, "label", "n").select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def op12_archive(spark, sf):
    folder = scratch_path(spark, "archive")
    warc.write_archive(table(spark, sf, "pages").select("page_id", "url", "html"), folder)
    return warc.read_archive(spark, folder)


def with_planted_runs(docs):
    """Texts in which one in ten documents goes on from a word of its own with its next words over and over."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.withColumns({"_h": h, "_g": F.floor(h / 10)}).withColumn("_w", native.word_array(F.col("text")))
    words = words.withColumn("_n", F.size("_w"))
    words = words.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    words = words.withColumn("_p", F.floor((F.col("_n") - F.col("_a")) / (F.col("_g") % 8 + 3)) + 1)
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")
    again = F.array_join(F.transform("_w", lambda w, i: F.get(F.col("_w"), place(i))), " ")
    return words.withColumn("text", F.when((F.col("_h") % 10 == 0) & (F.col("_n") > 0), again).otherwise(F.col("text"))).select(docs.columns)


def op13_periodic_runs(spark, sf):
    docs = with_planted_runs(table(spark, sf, "documents").select("doc_id", "text"))
    found = runs.with_runs(docs).select("doc_id", "found.*")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    period = -F.col("best.shorter")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        ((F.col("best.length") * 1000 - F.col("best.length") * 1000 % period) / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_url_filter": op3_url_filter,
    "op4_decontamination": op4_decontamination,
    "op5_window_dedup": op5_window_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_near_dup": op7_near_dup,
    "op8_order_minhash": op8_order_minhash,
    "op9_sentence_pieces": op9_sentence_pieces,
    "op10_language": op10_language,
    "op11_vector_codes": op11_vector_codes,
    "op12_archive": op12_archive,
    "op13_periodic_runs": op13_periodic_runs,
}

_HOST = "translate(case when instr(url, '://') > 0 then regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*') else '' end, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "case when instr(url, '://') > 0 then regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end"


def _under(host: str) -> str:
    return f"(host = '{host}' or ends_with(host, '.{host}'))"


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """All distances of all parts to all entries, round by round."""
    x = f"list_slice(v, part * len(v) // {parts} + 1, (part + 1) * len(v) // {parts})"
    steps = [
        """kept as materialized (select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"x as materialized (select vec_id, part, {x} as v from kept, range({parts}) t(part))",
        f"""b0 as materialized (select part, entry, v from x join (select vec_id, row_number() over (order by vec_id) - 1 as entry from kept) using (vec_id)
            where entry < {entries})""",
    ]
    for r in range(rounds + 1):
        far = "list_inner_product(x.v, x.v) + list_inner_product(b.v, b.v) - 2 * list_inner_product(x.v, b.v)"
        steps.append(f"a{r} as materialized (select x.vec_id, x.part, min({{'d': {far}, 'entry': b.entry}}) as m from x join b{r} b using (part) group by all)")
        if r < rounds:
            steps.append(f"""m{r} as (select part, entry, list((s - ((s % n) + n) % n) // n order by i) as v from
                (select part, m.entry as entry, i, sum(x.v[i]::bigint)::bigint as s, count(*) as n from a{r} join x using (vec_id, part), range(1, len(x.v) + 1) t(i) group by all)
                group by all)""")
            steps.append(f"b{r + 1} as materialized (select part, entry, coalesce(m.v::double[], b.v) as v from b{r} b left join m{r} m using (part, entry))")
    books = f"(select sha256(string_agg(v[i]::bigint::varchar, ',' order by part, entry, i)) as codebooks_sha256 from b{rounds}, range(1, len(v) + 1) t(i))"
    coded = f"(select vec_id, string_agg(printf('%02x', m.entry::int), '' order by part) as code, sum(m.d)::bigint as error from a{rounds} group by vec_id)"
    return f"""with {", ".join(steps)} select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
        from kept join {coded} using (vec_id), {books}"""


_BASE32 = """(select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hexed, 10 * (i // 8) + 1, 10))::bigint >> (35 - 5 * (i % 8))) & 31)::int + 1, 1), '' order by i)
    from range(32) t(i))"""

ORACLES = {
    "op11_vector_codes": _codes_sql(),
    "op12_archive": f"""select page_id, strlen(payload)::bigint as payload_bytes, {_BASE32} as payload_digest,
        case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to
        from (select *, sha1(payload) as hexed, max(page_id) over (partition by payload) as last from (select page_id, coalesce(html, '') as payload from pages))""",
    "op3_url_filter": f"""select page_id, host, path, rule, case rule when 'example.org/es/' then 'block' when 'example.org/en/1' then 'block' when 'com/de/' then 'block' else 'allow' end as verdict
        from (select *, case when {_under('example.org')} and starts_with(path, '/en/1') then 'example.org/en/1'
            when {_under('example.org')} and starts_with(path, '/es/') then 'example.org/es/'
            when {_under('com')} and starts_with(path, '/fr/') then 'com/fr/' when {_under('com')} and starts_with(path, '/de/') then 'com/de/'
            when {_under('org')} and starts_with(path, '/') then 'org/' end as rule
        from (select page_id, coalesce({_HOST}, '') as host, coalesce({_PATH}, '') as path from pages))""",
}
