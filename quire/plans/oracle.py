"""DuckDB SQL twins of the registered queries (tables are pre-registered views).

The SQL is written independently from the DataFrame code: HTML text by
regular expressions (RE2), ranks by window functions, cumulative sums by
window frames.  Column names and types match the Spark outputs.
"""

from __future__ import annotations

from quire.functions.html import ARTICLE_DROP, PLAIN_DROP, REGEX_ENTITIES

# RE2 forms of the patterns used on the Spark side.
PRETOKEN_RE2 = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
WS_RE2 = r"[\s\v\pZ\x{85}\x{1C}-\x{1F}]"
STRIP_RE2 = f"^{WS_RE2}+|{WS_RE2}+$"
L_PAGE = 64
L_ARTICLE = 256
SEED = 42
TEMPERATURE = 0.1


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def html_text_sql(col: str, drop, prefer_article: bool) -> tuple[str, str]:
    """(expression after dropping, final text expression over column ``h``)."""
    e = col
    for tag in drop:
        e = f"regexp_replace({e}, {_q(rf'(?is)<{tag}\b[^>]*>.*?</{tag}\s*>')}, chr(1), 'g')"
    t = "h"
    if prefer_article:
        art = f"regexp_extract(h, {_q(r'(?is)<article\b.*</article\s*>')}, 0)"
        t = f"(CASE WHEN {art} <> '' THEN {art} ELSE h END)"
    t = f"regexp_replace({t}, {_q(r'(?s)<!--.*?-->')}, chr(1), 'g')"
    t = f"regexp_replace({t}, {_q(r'(?s)<[^>]*>')}, chr(1), 'g')"
    for pat, rep in REGEX_ENTITIES:
        t = f"regexp_replace({t}, {_q(pat)}, {_q(rep)}, 'g')"
    t = (f"array_to_string(list_filter(list_transform(string_split({t}, chr(1)), "
         f"lambda x: regexp_replace(x, {_q(STRIP_RE2)}, '', 'g')), lambda x: x <> ''), ' ')")
    return e, t


def _pages_cte(name: str, drop, prefer_article: bool) -> str:
    e, t = html_text_sql("html", drop, prefer_article)
    return (f"{name}_h AS (SELECT page_id, url, {e} AS h FROM pages), "
            f"{name} AS (SELECT page_id, url, {t} AS text FROM {name}_h)")


PLAIN = _pages_cte("plain", PLAIN_DROP, False)
ARTICLE = _pages_cte("art", ARTICLE_DROP, True)
KEPT = ARTICLE + ", kept AS (SELECT page_id, url, text FROM art WHERE length(text) > 200)"


def _tok_ctes(src: str, key: str, prefix: str) -> str:
    """pre-tokens, vocabulary and ids of ``src(key, text)``."""
    return f"""
{prefix}_l AS (SELECT {key}, regexp_extract_all(text, {_q(PRETOKEN_RE2)}) AS l FROM {src}),
{prefix}_tok AS (SELECT {key}, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS token FROM {prefix}_l),
{prefix}_vocab AS (SELECT token, (row_number() OVER (ORDER BY cnt DESC, token ASC) + 1)::INTEGER AS id, cnt AS count
                   FROM (SELECT token, count(*) AS cnt FROM {prefix}_tok GROUP BY token)),
{prefix}_ids AS (SELECT t.{key}, t.pos, v.id FROM {prefix}_tok t JOIN {prefix}_vocab v USING (token)),
{prefix}_enc AS (SELECT {key}, list(id ORDER BY pos) AS ids FROM {prefix}_ids GROUP BY {key})"""


DOCS = "docs AS (SELECT doc_id, text FROM documents)"
DOC_TOK = DOCS + "," + _tok_ctes("docs", "doc_id", "d")


def _ids_text(e: str) -> str:
    return f"array_to_string({e}, ' ')"


def _pad(e: str, L: int) -> str:
    return f"list_concat({e}[1:{L}], list_resize([]::INTEGER[], greatest({L} - len({e}), 0), 0))"


def _mask(e: str, L: int) -> str:
    n = f"least(len({e}), {L})"
    return f"list_concat(list_resize([]::INTEGER[], {n}, 1), list_resize([]::INTEGER[], {L} - {n}, 0))"


URLS = """urls AS (SELECT page_id * 2 AS seq, url FROM pages
         UNION ALL SELECT page_id * 2 + 1 AS seq, regexp_replace(url, '[?#].*$', '') AS url FROM pages)"""

# one crawl pass: lookup, article text, > 200 chars, vocabulary fitted on kept pages, >= L ids
CRAWL = ", ".join([
    KEPT,
    _tok_ctes("kept", "page_id", "k").strip(),
    URLS,
    """onepage AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)""",
    """fetched AS (SELECT u.seq, u.url, o.page_id, a.text FROM urls u LEFT JOIN onepage o USING (url)
                LEFT JOIN art a ON a.page_id = o.page_id)""",
    f"""klen AS (SELECT page_id, len(ids) AS n FROM k_enc)""",
    f"""judged AS (SELECT f.seq, f.url, f.page_id,
                CASE WHEN f.page_id IS NULL THEN 'fetch_failed'
                     WHEN length(f.text) <= 200 THEN 'short_text'
                     WHEN coalesce(kl.n, 0) < {L_PAGE} THEN 'few_tokens' END AS reason,
                coalesce(kl.n, 0) AS n_ids
                FROM fetched f LEFT JOIN klen kl ON kl.page_id = f.page_id)""",
])

HISTORY = """hday AS (SELECT user_id AS run, CAST(ts AS DATE) AS day, round(avg(value), 6) AS eval_loss,
                 round(avg(ln(1 + value)), 6) AS train_loss, min(ts) AS first_ts
                 FROM events GROUP BY user_id, CAST(ts AS DATE)),
history AS (SELECT run, day, eval_loss, train_loss, first_ts,
            CAST(row_number() OVER (PARTITION BY run ORDER BY day) AS INTEGER) AS epoch FROM hday)"""

BEST = """best AS (SELECT run, arg_min(epoch, (eval_loss, epoch)) AS best_epoch, min(eval_loss) AS best_loss
         FROM history WHERE NOT isnan(eval_loss) AND eval_loss < 'inf'::DOUBLE GROUP BY run)"""

RUN_NAMES = """starts AS (SELECT run, min(first_ts) AS ts FROM history GROUP BY run),
names AS (SELECT strftime(ts, '%Y-%m-%d_%H-%M-%S') AS run_time FROM starts
          UNION ALL SELECT strftime(ts, '%Y-%m-%d') FROM starts
          UNION ALL SELECT strftime(ts, '%Y-%m-%d_%H-%M-%S') || '_old' FROM starts)"""

LOGITS = "lg AS (SELECT vec_id, embedding, label FROM embeddings)"
# long form: token_id 0-based, z = logit / T as double
LONG = f"""{LOGITS},
lz AS (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1))::INTEGER AS token_id,
              unnest(embedding)::DOUBLE / {TEMPERATURE} AS z FROM lg),
lp AS (SELECT vec_id, token_id, z, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM lz),
lprob AS (SELECT vec_id, token_id, z, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM lp),
lrank AS (SELECT vec_id, token_id, z, p,
          row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, token_id ASC) AS rn FROM lprob),
u AS (SELECT vec_id, ('0x' || substring(md5(CAST(vec_id AS VARCHAR) || ':' || '{SEED}'), 1, 8))::BIGINT / 4294967296.0 AS u FROM lg)"""

TOPK = LONG + """,
tk AS (SELECT vec_id, token_id, z, rn FROM lrank WHERE rn <= 10),
tke AS (SELECT vec_id, token_id, rn, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM tk),
tkp AS (SELECT vec_id, token_id, rn, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM tke)"""

NUCLEUS = LONG + """,
cum AS (SELECT vec_id, token_id, rn, p,
        sum(p) OVER (PARTITION BY vec_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
        FROM lrank),
nk AS (SELECT vec_id, token_id, rn, p FROM cum WHERE rn = 1 OR before <= 0.9),
nkp AS (SELECT vec_id, token_id, rn, p / sum(p) OVER (PARTITION BY vec_id) AS p FROM nk)"""


def _draw(src: str) -> str:
    return f"""
, dc AS (SELECT vec_id, token_id, rn,
         sum(p) OVER (PARTITION BY vec_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM {src}),
picked AS (SELECT d.vec_id, min(d.rn) AS rn FROM dc d JOIN u USING (vec_id) WHERE d.c > u.u GROUP BY d.vec_id),
last AS (SELECT vec_id, max(rn) AS rn FROM {src} GROUP BY vec_id),
choice AS (SELECT l.vec_id, coalesce(p.rn, l.rn) AS rn FROM last l LEFT JOIN picked p USING (vec_id))
SELECT c.vec_id, s.token_id FROM choice c JOIN {src} s ON s.vec_id = c.vec_id AND s.rn = c.rn"""


NLL = DOC_TOK + """,
total AS (SELECT sum(count) AS total FROM d_vocab),
nll AS (SELECT i.doc_id, i.pos, i.id AS label, -ln(v.count / t.total) AS nll, (i.pos // 64)::INTEGER AS chunk
        FROM d_ids i JOIN d_vocab v USING (id) CROSS JOIN total t),
bl AS (SELECT doc_id, chunk, avg(CASE WHEN label <> 0 AND NOT isnan(nll) THEN nll END) AS loss,
       count_if(label <> 0 AND NOT isnan(nll)) AS n_tokens FROM nll GROUP BY doc_id, chunk)"""

SHUF = """sh AS (SELECT doc_id, ('0x' || substring(md5(CAST(doc_id AS VARCHAR) || ':' || '42' || ':' || '1'), 1, 15))::BIGINT AS shuffle_key
        FROM documents),
ord AS (SELECT doc_id, shuffle_key, row_number() OVER (ORDER BY shuffle_key, doc_id) - 1 AS row_idx FROM sh),
bat AS (SELECT doc_id, shuffle_key, row_idx, (row_idx // 32) AS batch_id, (row_idx % 32) AS batch_pos FROM ord)"""


SQL: dict[str, str] = {
    "page_text": f"WITH {PLAIN} SELECT page_id, text FROM plain",
    "article_text_kept": f"WITH {KEPT} SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM kept",
    "crawl_corpus_lines": f"""WITH {PLAIN}, {URLS},
        onepage AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)
        SELECT u.seq, regexp_replace(p.text, '\\r\\n|\\r|\\n', ' ', 'g') AS line
        FROM urls u JOIN onepage o USING (url) JOIN plain p ON p.page_id = o.page_id
        WHERE p.text <> ''""",
    "page_chunks": f"""WITH {KEPT}, {_tok_ctes('kept', 'page_id', 'k').strip()},
        ch AS (SELECT e.page_id, unnest(generate_series(0, len(e.ids) // {L_PAGE} - 1)) AS chunk_idx, e.ids
               FROM k_enc e WHERE len(e.ids) >= {L_PAGE})
        SELECT c.page_id, k.url, c.chunk_idx::INTEGER AS chunk_idx, (c.chunk_idx * {L_PAGE})::INTEGER AS start,
               {_ids_text(f'c.ids[c.chunk_idx * {L_PAGE} + 1 : (c.chunk_idx + 1) * {L_PAGE}]')} AS input_ids,
               {L_PAGE}::INTEGER AS mask_len
        FROM ch c JOIN kept k USING (page_id)""",
    "chunks_per_url": f"""WITH {CRAWL}
        SELECT seq, url, (CASE WHEN reason IS NULL THEN n_ids // {L_PAGE} ELSE 0 END)::BIGINT AS n_chunks FROM judged""",
    "crawl_rejects": f"""WITH {CRAWL}
        SELECT seq, url, CASE WHEN seq = min(seq) OVER (PARTITION BY url) THEN reason ELSE 'blocklisted' END AS reason
        FROM judged WHERE reason IS NOT NULL""",
    "crawl_summary": f"""WITH {CRAWL},
        per AS (SELECT seq, (CASE WHEN reason IS NULL THEN n_ids // {L_PAGE} ELSE 0 END) AS n FROM judged)
        SELECT count_if(n > 0) AS successful, coalesce(sum(n), 0)::BIGINT AS chunks, count_if(n > 0) = 0 AS no_success FROM per""",
    "skip_blocklist": f"""WITH {CRAWL}
        SELECT seq, url FROM urls WHERE url NOT IN (SELECT url FROM judged WHERE reason IS NOT NULL)""",
    "corpus_lines": f"""WITH {DOCS},
        sp AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM docs),
        ex AS (SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS pos, unnest(parts) AS line FROM sp)
        SELECT doc_id, pos::BIGINT AS pos, regexp_replace(line, {_q(STRIP_RE2)}, '', 'g') AS text FROM ex
        WHERE regexp_replace(line, {_q(STRIP_RE2)}, '', 'g') <> ''""",
    "repeat_lines": f"""WITH {DOCS},
        sp AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM docs),
        ex AS (SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS pos, unnest(parts) AS line FROM sp),
        ln AS (SELECT doc_id, pos, regexp_replace(line, {_q(STRIP_RE2)}, '', 'g') AS text FROM ex),
        nb AS (SELECT text, row_number() OVER (ORDER BY doc_id, pos) - 1 AS lp FROM ln WHERE text <> ''),
        n AS (SELECT count(*) AS n FROM nb)
        SELECT (r.rep * n.n + nb.lp)::BIGINT AS line_id, nb.text
        FROM nb CROSS JOIN (SELECT unnest(generate_series(0, 99)) AS rep) r CROSS JOIN n""",
    "nonempty_records": """SELECT 'conversation' AS kind, conv_id AS rec_id, turn, text FROM conversations
        WHERE text IS NOT NULL AND text <> ''
        UNION ALL SELECT 'document', doc_id, 0::BIGINT, text FROM documents WHERE text IS NOT NULL AND text <> ''""",
    "pretokens": f"""WITH {DOCS},
        l AS (SELECT doc_id, regexp_extract_all(text, {_q(PRETOKEN_RE2)}) AS l FROM docs)
        SELECT doc_id, unnest(generate_series(0, len(l) - 1))::BIGINT AS pos, unnest(l) AS token FROM l""",
    "vocab": f"WITH {DOC_TOK} SELECT token, id, count::BIGINT AS count FROM d_vocab",
    "encoded_docs": f"WITH {DOC_TOK} SELECT doc_id, len(ids)::BIGINT AS n_ids, {_ids_text('ids')} AS ids FROM d_enc",
    "decode_roundtrip": f"""WITH {DOC_TOK},
        dec AS (SELECT i.doc_id, string_agg(v.token, '' ORDER BY i.pos) AS decoded
                FROM d_ids i JOIN d_vocab v USING (id) GROUP BY i.doc_id)
        SELECT d.doc_id, d.decoded AS text, d.decoded = s.text AS same FROM dec d JOIN docs s USING (doc_id)""",
    "padded_rows": f"""WITH {DOC_TOK}
        SELECT doc_id, {_ids_text(_pad('ids', 64))} AS input_ids, {_ids_text(_mask('ids', 64))} AS attention_mask FROM d_enc""",
    "attention_mask": f"""WITH {DOC_TOK},
        p AS (SELECT doc_id, {_pad('ids', 64)} AS ids, least(len(ids), 64) AS n FROM d_enc)
        SELECT doc_id, n::BIGINT AS n_real, len(list_filter(ids, lambda x: x <> 0))::BIGINT AS n_not_pad,
               {_ids_text("list_transform(ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END)")} AS mask_not_pad FROM p""",
    "shifted_pairs": f"""WITH {DOC_TOK},
        p AS (SELECT doc_id, {_pad('ids', 64)} AS ids, {_mask('ids', 64)} AS m FROM d_enc)
        SELECT doc_id, {_ids_text('ids[1:63]')} AS dec_input_ids, {_ids_text('m[1:63]')} AS dec_attention_mask,
               {_ids_text('ids[2:64]')} AS labels FROM p""",
    "article_chunks": f"""WITH {DOC_TOK},
        cut AS (SELECT e.doc_id, e.ids FROM d_enc e),
        ch AS (SELECT doc_id, unnest(generate_series(0, len(ids) // {L_ARTICLE} - 1)) AS chunk_idx, ids
               FROM cut WHERE len(ids) >= {L_ARTICLE})
        SELECT doc_id, chunk_idx::INTEGER AS chunk_idx, (chunk_idx * {L_ARTICLE})::INTEGER AS start,
               {_ids_text(f'ids[chunk_idx * {L_ARTICLE} + 1 : (chunk_idx + 1) * {L_ARTICLE}]')} AS input_ids FROM ch""",
    "cut_at_eos": f"""WITH {DOC_TOK},
        g AS (SELECT doc_id, ids, ids[9:] AS gen FROM d_enc),
        k AS (SELECT doc_id, ids, gen, CASE WHEN list_position(gen, 2) IS NOT NULL
                     THEN least(list_position(gen, 2), 56) ELSE least(len(gen), 56) END AS keep FROM g)
        SELECT doc_id, {_ids_text('list_concat(ids[1:8], gen[1:keep])')} AS ids,
               len(list_concat(ids[1:8], gen[1:keep]))::BIGINT AS n_ids FROM k""",
    "shuffled_order": f"WITH {SHUF} SELECT doc_id, shuffle_key, row_idx::BIGINT AS row_idx FROM bat",
    "batches": f"""WITH {SHUF}
        SELECT batch_id::BIGINT AS batch_id, string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY batch_pos) AS doc_ids,
               count(*)::BIGINT AS n_rows FROM bat GROUP BY batch_id""",
    "batch_sizes": f"WITH {SHUF} SELECT batch_id::BIGINT AS batch_id, count(*)::BIGINT AS n_rows FROM bat GROUP BY batch_id",
    "token_nll": f"""WITH {LOGITS},
        z AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
                     unnest(generate_series(0, len(embedding) - 1)) AS i FROM lg),
        m AS (SELECT vec_id, max(x) AS mx FROM z GROUP BY vec_id),
        s AS (SELECT z.vec_id, ln(sum(exp(z.x - m.mx))) + m.mx AS lse,
                     max(CASE WHEN z.i = z.label THEN z.x END) AS zl FROM z JOIN m USING (vec_id) GROUP BY z.vec_id, m.mx)
        SELECT vec_id, round(lse - zl, 6) AS nll FROM s""",
    "batch_loss": f"WITH {NLL} SELECT doc_id, chunk, round(loss, 6) AS loss, n_tokens::BIGINT AS n_tokens FROM bl",
    "evaluate": f"""WITH {NLL},
        first AS (SELECT loss FROM bl)
        SELECT round(coalesce(avg(loss), 'inf'::DOUBLE), 6) AS eval_loss,
               round(exp(coalesce(avg(loss), 'inf'::DOUBLE)), 6) AS perplexity, count(loss)::BIGINT AS n_batches FROM first""",
    "epoch_loss": f"""WITH {NLL}
        SELECT doc_id, round(avg(loss), 6) AS train_loss, count(loss)::BIGINT AS n_batches FROM bl GROUP BY doc_id""",
    "running_loss": f"""WITH {NLL}
        SELECT doc_id, chunk, round(avg(loss) OVER (PARTITION BY doc_id ORDER BY chunk
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_loss FROM bl""",
    "early_stop": f"""WITH {HISTORY},
        bb AS (SELECT run, epoch, eval_loss,
               coalesce(min(eval_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                        'inf'::DOUBLE) AS best_before FROM history),
        fl AS (SELECT *, CASE WHEN eval_loss < best_before - 0.001 THEN 1 ELSE 0 END AS reset,
                         CASE WHEN eval_loss < best_before THEN 0 ELSE 1 END AS miss FROM bb),
        g AS (SELECT *, sum(reset) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM fl),
        c AS (SELECT run, epoch, eval_loss,
              CAST(sum(miss) OVER (PARTITION BY run, grp ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS counter FROM g),
        s AS (SELECT *, counter >= 3 AS stop, min(CASE WHEN counter >= 3 THEN epoch END) OVER (PARTITION BY run) AS fs FROM c)
        SELECT run, epoch, eval_loss, counter, stop FROM s WHERE fs IS NULL OR epoch <= fs""",
    "running_best": f"""WITH {HISTORY},
        bb AS (SELECT run, epoch, eval_loss,
               coalesce(min(eval_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                        'inf'::DOUBLE) AS best_before FROM history)
        SELECT run, epoch, best_before, coalesce(eval_loss < best_before, false) AS is_best FROM bb""",
    "best_epoch": f"WITH {HISTORY}, {BEST} SELECT run, best_epoch, best_loss FROM best",
    "lr_schedule": f"""WITH {HISTORY}
        SELECT run, epoch, train_loss, eval_loss, round(0.0001 * pow(0.95, epoch - 1), 12) AS lr FROM history""",
    "list_runs": f"""WITH {HISTORY}, {RUN_NAMES}
        SELECT DISTINCT run_time FROM names WHERE regexp_matches(run_time, '^\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d{{2}}-\\d{{2}}-\\d{{2}}$')""",
    "promote_best": f"""WITH {HISTORY}, {BEST}, {RUN_NAMES},
        rr AS (SELECT strftime(s.ts, '%Y-%m-%d_%H-%M-%S') AS run_time, b.best_epoch AS epoch, b.best_loss AS eval_loss
               FROM best b JOIN starts s USING (run)),
        req AS (SELECT DISTINCT run_time FROM names
                WHERE regexp_matches(run_time, '^\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d{{2}}-\\d{{2}}-\\d{{2}}$')),
        f AS (SELECT q.run_time, r.epoch, r.eval_loss FROM req q JOIN rr r USING (run_time))
        SELECT 'quire-model' AS model_name, arg_max(run_time, run_time) AS run_time, arg_max(epoch, run_time) AS epoch,
               arg_max(eval_loss, run_time) AS eval_loss, 'registry/quire-model' AS path FROM f""",
    "resume_point": f"""WITH {HISTORY}, {BEST},
        r AS (SELECT DISTINCT run FROM history)
        SELECT r.run, b.best_epoch, (coalesce(b.best_epoch, 0) + 1)::INTEGER AS start_epoch FROM r LEFT JOIN best b USING (run)""",
    "config_merge": """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '0') AS k,
        coalesce(json_extract_string(props, '$.max_len'), '256') AS max_len,
        (3 + coalesce(len(list_filter(json_keys(props), lambda x: x NOT IN ('k', 'max_len', 'batch_size'))), 0))::BIGINT AS n_keys
        FROM events""",
    "config_from_json": """SELECT event_id, CASE WHEN event_type = 'purchase' THEN json_extract_string(props, '$.k')
        ELSE 'arg-' || event_type END AS k FROM events""",
    "softmax": f"WITH {LONG} SELECT vec_id, token_id, round(p, 6) AS prob FROM lprob",
    "greedy": f"""WITH {LOGITS},
        z AS (SELECT vec_id, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1))::INTEGER AS i FROM lg)
        SELECT vec_id, arg_min(i, (-x, i))::INTEGER AS token_id FROM z GROUP BY vec_id""",
    "top_k_set": f"WITH {TOPK} SELECT vec_id, rn::INTEGER AS rank, token_id, round(p, 6) AS prob FROM tkp",
    "top_k_draw": f"WITH {TOPK}, src AS (SELECT vec_id, token_id, rn, p FROM tkp)" + _draw("src"),
    "nucleus": f"WITH {NUCLEUS} SELECT vec_id, rn::INTEGER AS rank, token_id, round(p, 6) AS prob FROM nkp",
    "top_p_draw": f"WITH {NUCLEUS}, src AS (SELECT vec_id, token_id, rn, p FROM nkp)" + _draw("src"),
}

SQL["stream_page_chunks"] = SQL["page_chunks"]
SQL["stream_padded_rows"] = SQL["padded_rows"]
SQL["stream_rejects"] = f"""WITH {KEPT}, {_tok_ctes('kept', 'page_id', 'k').strip()},
    j AS (SELECT a.page_id, a.url, CASE WHEN length(a.text) <= 200 THEN 'short_text'
                 WHEN coalesce(len(e.ids), 0) < {L_PAGE} THEN 'few_tokens' END AS reason
          FROM art a LEFT JOIN k_enc e USING (page_id))
    SELECT page_id, url, reason FROM j WHERE reason IS NOT NULL"""

SQL["run_snapshots"] = f"""WITH {HISTORY},
    bb AS (SELECT run, epoch, eval_loss,
           coalesce(min(eval_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    'inf'::DOUBLE) AS best_before FROM history),
    fl AS (SELECT *, CASE WHEN eval_loss < best_before - 0.001 THEN 1 ELSE 0 END AS reset,
                     CASE WHEN eval_loss < best_before THEN 0 ELSE 1 END AS miss FROM bb),
    g AS (SELECT *, sum(reset) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM fl),
    c AS (SELECT run, epoch, eval_loss, best_before,
          sum(miss) OVER (PARTITION BY run, grp ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counter FROM g),
    s AS (SELECT *, min(CASE WHEN counter >= 3 THEN epoch END) OVER (PARTITION BY run) AS fs FROM c),
    kept AS (SELECT * FROM s WHERE fs IS NULL OR epoch <= fs)
    SELECT run, epoch, eval_loss, 'best' AS kind FROM kept WHERE eval_loss < best_before
    UNION ALL SELECT run, epoch, eval_loss, 'earlystop' AS kind FROM kept WHERE counter >= 3"""


def bpe_encode_sql(merges: int) -> str:
    """A fit merge by merge as a recursion over word types (rows of ``w`` >= 0; row -r holds merge r), then the ids of every text.

    Each symbol stands between chr(1) and chr(2), so one replacement merges a pair from left to right."""
    from quire.operators.bpe import byte_chars
    chars = "[" + ", ".join(_q(c) for c in byte_chars()) + "]"
    start = ("list_aggregate(list_transform(range(octet_length(encode(token))::BIGINT), lambda i: chr(1) || "
             f"ch.c[('0x' || substr(hex(encode(token)), (2 * i + 1)::BIGINT, 2))::INT + 1] || chr(2)), 'string_agg', '')")
    return f"""WITH RECURSIVE ch AS (SELECT {chars} AS c), {DOCS},
    l AS (SELECT doc_id, regexp_extract_all(text, {_q(PRETOKEN_RE2)}) AS l FROM docs),
    tok AS (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS token FROM l),
    types AS MATERIALIZED (SELECT row_number() OVER (ORDER BY token) AS w, token, n, {start} AS sym
              FROM (SELECT token, count(*) AS n FROM tok GROUP BY token), ch),
    fit(w, sym, n, a, b) USING KEY (w) AS (
      SELECT w, sym, n, NULL::VARCHAR, NULL::VARCHAR FROM types
      UNION ALL (
        WITH s AS (SELECT n, string_split(sym[2:len(sym) - 1], chr(2) || chr(1)) AS l FROM recurring.fit WHERE w > 0),
        pairs AS (SELECT n, unnest(l[1:len(l) - 1]) AS a, unnest(l[2:]) AS b FROM s WHERE len(l) > 1),
        best AS (SELECT a AS x, b AS y FROM pairs GROUP BY a, b ORDER BY sum(n) DESC, a, b LIMIT 1),
        made AS (SELECT -count(*) - 1 AS w FROM recurring.fit WHERE w < 0)
        SELECT f.w, replace(f.sym, chr(1) || x || chr(2) || chr(1) || y || chr(2), chr(1) || x || y || chr(2)), f.n, NULL, NULL
        FROM recurring.fit f, best, made
        WHERE f.w > 0 AND made.w >= -{merges} AND contains(f.sym, chr(1) || x || chr(2) || chr(1) || y || chr(2))
        UNION ALL SELECT made.w, NULL, NULL, x, y FROM best, made WHERE made.w >= -{merges})),
    ids AS (SELECT a || b AS s, 256 - w AS id FROM fit WHERE w < 0
            UNION ALL SELECT unnest(c), unnest(range(1, 257)) FROM ch),
    parts AS (SELECT w, unnest(generate_series(0, len(l) - 1)) AS i, unnest(l) AS s
              FROM (SELECT w, string_split(sym[2:len(sym) - 1], chr(2) || chr(1)) AS l FROM fit WHERE w > 0)),
    coded AS (SELECT token, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids, count(*) AS k
              FROM parts JOIN ids USING (s) JOIN types USING (w) GROUP BY token)
    SELECT doc_id, coalesce(sum(k), 0)::BIGINT AS n_ids, coalesce(string_agg(ids, ' ' ORDER BY pos), '') AS ids
    FROM docs LEFT JOIN tok USING (doc_id) LEFT JOIN coded USING (token) GROUP BY doc_id"""


#: As many as the query makes.
SQL["bpe_encode"] = bpe_encode_sql(512)

# a vocabulary of the conversations, unknown id 1
GIVEN = f"""convs AS (SELECT conv_id, turn, text FROM conversations),
c_tok AS (SELECT unnest(regexp_extract_all(text, {_q(PRETOKEN_RE2)})) AS token FROM convs),
c_vocab AS (SELECT token, (row_number() OVER (ORDER BY cnt DESC, token ASC) + 1)::INTEGER AS id, cnt AS count
            FROM (SELECT token, count(*) AS cnt FROM c_tok GROUP BY token)),
{DOCS},
g_l AS (SELECT doc_id, regexp_extract_all(text, {_q(PRETOKEN_RE2)}) AS l FROM docs),
g_tok AS (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS token FROM g_l),
g_ids AS (SELECT doc_id, pos, t.token, v.token AS known, coalesce(v.id, 1) AS id FROM g_tok t LEFT JOIN c_vocab v USING (token))"""

SQL["given_vocab_ids"] = f"""WITH {GIVEN}
    SELECT doc_id, count(id)::BIGINT AS n_ids, (count(*) FILTER (id = 1))::BIGINT AS n_unknown,
           coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pos), '') AS ids, coalesce(string_agg(known, '' ORDER BY pos), '') AS decoded
    FROM docs LEFT JOIN g_ids USING (doc_id) GROUP BY doc_id"""

SQL["given_vocab_pieces"] = f"""WITH RECURSIVE {GIVEN},
    pieces AS MATERIALIZED (SELECT token, id FROM c_vocab),
    longest AS (SELECT max(length(token)) AS m FROM pieces),
    cut(token, k, f, id) AS (
      SELECT token, 0, 1, NULL::INTEGER FROM (SELECT DISTINCT token FROM g_ids WHERE known IS NULL)
      UNION ALL
      SELECT token, k + 1, f + greatest(coalesce(max(l) FILTER (pid IS NOT NULL), 1), 1), coalesce(arg_max(pid, l) FILTER (pid IS NOT NULL), 1)
      FROM (SELECT c.token, c.k, c.f, length(p.token) AS l, p.id AS pid FROM
              (SELECT cut.token, cut.k, cut.f, unnest(generate_series(1, least(m, length(cut.token) - cut.f + 1))) AS n
               FROM cut, longest WHERE cut.f <= length(cut.token)) c
            LEFT JOIN pieces p ON p.token = substr(c.token, c.f, c.n))
      GROUP BY token, k, f),
    own AS (SELECT token, string_agg(id::VARCHAR, ' ' ORDER BY k) AS ids, count(*) AS n, count(*) FILTER (id = 1) AS u
            FROM cut WHERE k > 0 GROUP BY token)
    SELECT doc_id, coalesce(sum(CASE WHEN known IS NULL THEN n ELSE 1 END) FILTER (g_ids.id IS NOT NULL), 0)::BIGINT AS n_ids,
           coalesce(sum(u) FILTER (known IS NULL), 0)::BIGINT AS n_unknown,
           coalesce(string_agg(CASE WHEN known IS NULL THEN own.ids ELSE g_ids.id::VARCHAR END, ' ' ORDER BY pos), '') AS ids
    FROM docs LEFT JOIN g_ids USING (doc_id) LEFT JOIN own ON own.token = g_ids.token GROUP BY doc_id"""

SQL["padded_loss"] = f"""WITH {GIVEN},
    total AS (SELECT sum(count + 1) + 2 AS t FROM c_vocab),
    lab AS (SELECT doc_id, g_ids.id, coalesce(v.count, 0) AS c FROM g_ids LEFT JOIN c_vocab v ON v.token = g_ids.known
            WHERE pos BETWEEN 1 AND 255)
    SELECT doc_id, round(avg(-ln((c + 1) / t)), 6) AS loss, count(c)::BIGINT AS n_tokens
    FROM docs LEFT JOIN lab USING (doc_id) CROSS JOIN total GROUP BY doc_id"""


def epoch_batches_sql(rounds: int = 4) -> str:
    """The permutation round by round; places from n on go through it again."""
    half = lambda r, c: (f"('0x' || substring(md5('{SEED}:' || epoch || ':{r}:' || {c}), 1, 15))::BIGINT")
    state, ctes = "s0", []
    for r in range(rounds):
        new = (f"(l + {half(r, 'r')}) % a AS l, r" if r % 2 == 0 else f"l, (r + {half(r, 'l')}) % b AS r")
        ctes.append(f"s{r + 1} AS (SELECT i, epoch, a, b, n, {new} FROM s{r})")
    return f"""WITH RECURSIVE {DOC_TOK},
    size AS (SELECT n, (floor(sqrt(n - 1)) + 1)::BIGINT AS a FROM (SELECT count(*) AS n FROM docs)),
    walk(i, epoch, x, a, b, n) AS (
      SELECT i, epoch, NULL::BIGINT, a, ((n + a - 1) // a)::BIGINT, n
      FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i FROM docs), (SELECT unnest([1, 2]) AS epoch), size
      UNION ALL (
        WITH s0 AS (SELECT i, epoch, a, b, n, coalesce(x, i) % a AS l, coalesce(x, i) // a AS r FROM walk WHERE x IS NULL OR x >= n),
        {", ".join(ctes)}
        SELECT i, epoch, r * a + l, a, b, n FROM s{rounds})),
    place AS (SELECT doc_id, epoch, x // 32 AS batch_id, x % 32 AS pos FROM walk
              JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM docs) USING (i) WHERE x < n),
    rows_ AS (SELECT doc_id, {_ids_text(_pad('ids', 64))} AS ids, least(len(ids), 64) AS n_real FROM d_enc)
    SELECT epoch::INTEGER AS epoch, batch_id::BIGINT AS batch_id, count(*)::BIGINT AS n_rows,
           string_agg(doc_id::VARCHAR, ' ' ORDER BY pos) AS doc_ids, md5(string_agg(ids, ' ' ORDER BY pos)) AS ids_md5,
           sum(n_real)::BIGINT AS n_real FROM place JOIN rows_ USING (doc_id) GROUP BY epoch, batch_id"""


SQL["epoch_batches"] = epoch_batches_sql()

_STREAM = f"""{KEPT}, {_tok_ctes('kept', 'page_id', 'k').strip()},
    firsts AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url),
    verdict AS (SELECT f.url, f.page_id AS first, coalesce(len(e.ids), 0) AS n,
                       CASE WHEN length(a.text) <= 200 THEN 'short_text' WHEN coalesce(len(e.ids), 0) < {L_PAGE} THEN 'few_tokens' END AS reason
                FROM firsts f JOIN art a USING (page_id) LEFT JOIN k_enc e USING (page_id))"""

SQL["stream_recrawl"] = f"""WITH {_STREAM}
    SELECT page_id, url, CASE WHEN page_id = first THEN reason ELSE 'blocklisted' END AS reason
    FROM pages JOIN verdict USING (url) WHERE reason IS NOT NULL
    UNION ALL SELECT -page_id - 1, url, 'blocklisted' FROM pages JOIN verdict USING (url) WHERE reason IS NOT NULL"""

SQL["stream_metric_log"] = f"""WITH {_STREAM},
    r AS (SELECT reason, n FROM pages JOIN verdict USING (url))
    SELECT 'n_chunks' AS tag, coalesce(sum(n // {L_PAGE}) FILTER (reason IS NULL), 0)::BIGINT AS value FROM r
    UNION ALL SELECT 'n_pages', count(*) FILTER (reason IS NULL) FROM r
    UNION ALL SELECT 'n_rejects', count(*) FILTER (reason IS NOT NULL) FROM r"""

_FOLD = f"""{HISTORY},
    bb AS (SELECT run, epoch, eval_loss, train_loss,
           coalesce(min(eval_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    'inf'::DOUBLE) AS best_before FROM history),
    fl AS (SELECT *, CASE WHEN eval_loss < best_before - 0.001 THEN 1 ELSE 0 END AS reset,
                     CASE WHEN eval_loss < best_before THEN 0 ELSE 1 END AS miss FROM bb),
    g AS (SELECT *, sum(reset) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM fl),
    c AS (SELECT run, epoch, eval_loss, train_loss, best_before,
          CAST(sum(miss) OVER (PARTITION BY run, grp ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS counter FROM g)"""

# the fold over the whole run, never interrupted
SQL["resumed_early_stop"] = f"""WITH {_FOLD} SELECT run, epoch, eval_loss, counter, counter >= 3 AS stop FROM c"""

SQL["full_snapshots"] = f"""WITH {_FOLD},
    s AS (SELECT *, min(CASE WHEN counter >= 3 THEN epoch END) OVER (PARTITION BY run) AS fs FROM c),
    marks AS (SELECT run, 'best' AS kind, max(epoch) AS at_ FROM s WHERE (fs IS NULL OR epoch <= fs) AND eval_loss < best_before GROUP BY run
              UNION ALL SELECT DISTINCT run, 'earlystop', fs FROM s WHERE fs IS NOT NULL)
    SELECT m.run, m.kind, m.at_ AS epoch,
           string_agg(round(c.eval_loss * 1e6)::BIGINT::VARCHAR, ' ' ORDER BY c.epoch) AS eval_history,
           string_agg(round(c.train_loss * 1e6)::BIGINT::VARCHAR, ' ' ORDER BY c.epoch) AS train_history, count(*) AS n_lr,
           round(min(c.eval_loss), 6) AS best, arg_max(c.counter, c.epoch) AS counter, m.run::VARCHAR AS config_run
    FROM marks m JOIN c ON c.run = m.run AND c.epoch <= m.at_ GROUP BY m.run, m.kind, m.at_"""

SQL["history_files"] = f"""WITH {HISTORY}
    SELECT run, epoch, round(train_loss, 6) AS train_loss, round(eval_loss, 6) AS eval_loss, round(eval_loss, 6) AS json_eval, true AS same_lr
    FROM history"""

SQL["registry_publish"] = SQL["promote_best"]

SQL["capped_articles"] = f"""WITH {DOC_TOK},
    firsts AS (SELECT doc_id FROM docs ORDER BY doc_id LIMIT 150),
    cut AS (SELECT doc_id, ids[1:512] AS ids FROM d_enc WHERE doc_id IN (SELECT doc_id FROM firsts)),
    ch AS (SELECT doc_id, unnest(generate_series(0, len(ids) // 64 - 1)) AS chunk_idx, ids FROM cut WHERE len(ids) >= 64)
    SELECT doc_id, chunk_idx::INTEGER AS chunk_idx, {_ids_text('ids[chunk_idx * 64 + 1 : (chunk_idx + 1) * 64]')} AS input_ids FROM ch"""

SQL["named_corpus"] = """SELECT doc_id, source AS name, lang AS config, 'train' AS split, length(text)::BIGINT AS n_chars FROM documents
    WHERE source = (SELECT min(source) FROM documents) AND lang = 'en' AND doc_id % 7 <> 0 AND text IS NOT NULL AND text <> ''"""

SQL["crawl_rejects_long"] = SQL["crawl_rejects"].replace(f"coalesce(kl.n, 0) < {L_PAGE} ", "coalesce(kl.n, 0) < 512 ")

SQL["nonempty_derived"] = """SELECT doc_id, lang, CASE WHEN lang = 'es' THEN 1 ELSE length(text) END::BIGINT AS n_chars FROM documents
    WHERE lang IS NULL OR lang = 'es' OR lang NOT IN ('de', 'fr') AND text <> ''"""

SQL["sql_chunks"] = f"""WITH {DOC_TOK},
    ch AS (SELECT doc_id, unnest(generate_series(0, len(ids) // 64 - 1)) AS chunk_idx, ids FROM d_enc WHERE len(ids) >= 64)
    SELECT doc_id, chunk_idx::INTEGER AS chunk_idx, (chunk_idx * 64)::INTEGER AS start,
           {_ids_text('ids[chunk_idx * 64 + 1 : (chunk_idx + 1) * 64]')} AS input_ids FROM ch"""

SQL["saved_lines"] = f"""WITH {PLAIN}
    SELECT regexp_replace(text, '\\r\\n|\\r|\\n', ' ', 'g') AS line, count(*) AS n FROM plain WHERE text <> '' GROUP BY 1"""
