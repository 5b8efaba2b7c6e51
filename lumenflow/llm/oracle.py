"""DuckDB SQL of the queries that SQL can express (others: tests/llm)."""

SQL: dict[str, str] = {
    "op5_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM t JOIN g USING (body)""",
    "op2_url_filter": r"""
        WITH rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        named AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
        parsed AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM named),
        best AS (SELECT page_id, max(struct_pack(n := length(h || p), rule := h || p, verdict := verdict)) AS b
                 FROM parsed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
        FROM parsed LEFT JOIN best USING (page_id)""",
    "op9_preference_format": r"""
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
                   FROM conversations WHERE conv_id IS NOT NULL),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
        last AS (SELECT conv_id, max(i) AS pos FROM n WHERE role = 'assistant' GROUP BY conv_id),
        answer AS (SELECT n.conv_id, n.text FROM n JOIN last ON n.conv_id = last.conv_id AND n.i = last.pos),
        follow AS (SELECT conv_id, coalesce(lead(text) OVER (ORDER BY md5(conv_id::VARCHAR), conv_id),
                                            first(text) OVER (ORDER BY md5(conv_id::VARCHAR), conv_id)) AS text FROM answer),
        pair AS (SELECT last.conv_id, pos, a.text AS good, coalesce(b.text, f.text) AS bad, a.text = coalesce(b.text, f.text) AS tie
                 FROM last JOIN answer a ON a.conv_id = last.conv_id JOIN follow f ON f.conv_id = last.conv_id
                 LEFT JOIN answer b ON b.conv_id = xor(last.conv_id, 1)),
        prompt AS (SELECT p.conv_id, string_agg('<|im_start|>' || n.role || chr(10) || n.text || '<|im_end|>' || chr(10), '' ORDER BY n.i) AS prompt
                   FROM pair p JOIN n ON n.conv_id = p.conv_id AND (n.i < p.pos OR p.tie AND n.i = p.pos) GROUP BY p.conv_id)
        SELECT p.conv_id AS pair_id, CASE WHEN tie THEN pos ELSE pos - 1 END AS n_prompt_turns, coalesce(prompt, '') AS prompt,
               CASE WHEN tie THEN '' ELSE '<|im_start|>assistant' || chr(10) || good || '<|im_end|>' || chr(10) END AS chosen,
               CASE WHEN tie THEN '' ELSE '22-' || (22 + length(good) + 10) END AS chosen_loss,
               CASE WHEN tie THEN '' ELSE '<|im_start|>assistant' || chr(10) || bad || '<|im_end|>' || chr(10) END AS rejected,
               CASE WHEN tie THEN '' ELSE '22-' || (22 + length(bad) + 10) END AS rejected_loss, tie
        FROM pair p LEFT JOIN prompt USING (conv_id)""",
    "op7_source_mixing": r"""
        WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
                          coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS INT), 0) % 4 AS no FROM documents),
        items AS (SELECT doc_id, k, 'd' || no AS domain, 4 - no AS wd, lang, CASE WHEN lang = 'en' THEN 4 ELSE 2 END AS wl, source,
                         sum(tokens)::BIGINT AS tokens, count(*) AS n FROM d GROUP BY ALL),
        leaves AS (SELECT domain, wd, lang, wl, source, sum(tokens)::BIGINT AS tokens FROM items GROUP BY ALL),
        c1 AS (SELECT domain, wd AS w, sum(tokens)::BIGINT * 2 AS cap FROM leaves GROUP BY ALL),
        o1 AS (SELECT *, (SELECT sum(tokens)::BIGINT FROM leaves) - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lft,
                      sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rst,
                      row_number() OVER (ORDER BY cap / w, domain) AS nth FROM c1),
        f1 AS (SELECT min(nth) AS nth, arg_min(lft, nth) AS lft, arg_min(rst, nth) AS rst FROM o1 WHERE cap * rst > lft * w),
        b1 AS (SELECT domain, CASE WHEN f1.nth IS NULL OR o1.nth < f1.nth THEN cap ELSE (f1.lft * w) // f1.rst END AS budget FROM o1, f1),
        c2 AS (SELECT domain, lang, wl AS w, sum(tokens)::BIGINT * 2 AS cap FROM leaves GROUP BY ALL),
        o2 AS (SELECT c2.*, budget - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lft,
                      sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rst,
                      row_number() OVER (PARTITION BY domain ORDER BY cap / w, lang) AS nth FROM c2 JOIN b1 USING (domain)),
        f2 AS (SELECT domain, min(nth) AS nth, arg_min(lft, nth) AS lft, arg_min(rst, nth) AS rst FROM o2 WHERE cap * rst > lft * w GROUP BY domain),
        b2 AS (SELECT domain, lang, CASE WHEN f2.nth IS NULL OR o2.nth < f2.nth THEN cap ELSE (f2.lft * w) // f2.rst END AS budget FROM o2 LEFT JOIN f2 USING (domain)),
        c3 AS (SELECT domain, lang, source, 1 AS w, tokens, tokens * 2 AS cap FROM leaves),
        o3 AS (SELECT c3.*, budget - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lft,
                      sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rst,
                      row_number() OVER (PARTITION BY domain, lang ORDER BY cap / w, source) AS nth FROM c3 JOIN b2 USING (domain, lang)),
        f3 AS (SELECT domain, lang, min(nth) AS nth, arg_min(lft, nth) AS lft, arg_min(rst, nth) AS rst FROM o3 WHERE cap * rst > lft * w GROUP BY domain, lang),
        b3 AS (SELECT domain, lang, source, tokens AS total, CASE WHEN f3.nth IS NULL OR o3.nth < f3.nth THEN cap ELSE (f3.lft * w) // f3.rst END AS budget
               FROM o3 LEFT JOIN f3 USING (domain, lang)),
        q AS (SELECT *, CASE WHEN total > 0 THEN least(2, budget // greatest(total, 1)) ELSE 0 END AS epochs FROM b3),
        p AS (SELECT i.*, epochs, budget - epochs * total AS rest,
                     sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || epochs || ':' || coalesce(doc_id::VARCHAR, '') || ':' || k), doc_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
              FROM items i JOIN q USING (domain, lang, source)),
        c AS (SELECT *, epochs + CASE WHEN epochs < 2 AND run <= rest THEN 1 ELSE 0 END AS copies FROM p)
        SELECT doc_id, domain, lang, source, unnest(generate_series(0, copies - 1))::INT AS epoch, tokens // n AS n_tokens FROM c WHERE copies > 0""",
    "op4_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        windows AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS i,
                           unnest(list_transform(range(1, len(words) - 33), lambda i: md5(array_to_string(words[i:i + 34], ' ')))) AS k
                    FROM w WHERE len(words) >= 35),
        twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (k)),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op11_ranked_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        all_of AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
        tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
        w AS (SELECT item_id, term, times * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
              FROM q JOIN df USING (term), all_of),
        s AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
              FROM w JOIN tf USING (term), all_of GROUP BY item_id, r, doc_id),
        o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 20""",
    "op12_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || doc_id) AS h,
                          regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
        c AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
                     CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                            OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                          WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
        p AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
                     array_to_string(u[greatest(a, b) + 1:n], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(body) AS restored_sha256
        FROM p""",
    "op13_suffix_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        parts AS (SELECT r, doc_id, c, substr(h, 2 * c + 1, 2198) AS part FROM (
                    SELECT *, unnest(range(0, greatest(length(h) // 2 - 99, 0), 1000)) AS c FROM d)),
        w AS (SELECT r, doc_id, c + i AS pos, md5(substr(part, 2 * i + 1, 200)) AS k FROM (
                SELECT *, unnest(range(0, length(part) // 2 - 99)) AS i FROM parts)),
        f AS (SELECT k, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM w GROUP BY k HAVING count(*) > 1),
        g AS (SELECT r, pos, lag(pos) OVER (PARTITION BY r ORDER BY pos) AS before
              FROM w JOIN f USING (k) WHERE struct_pack(doc_id := doc_id, pos := pos) > first),
        n AS (SELECT r, pos, sum(CASE WHEN before IS NULL OR pos > before + 100 THEN 1 ELSE 0 END)
                OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM g),
        runs AS (SELECT r, no, min(pos) AS a, max(pos) + 100 AS b FROM n GROUP BY r, no),
        gaps AS (SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS x, a AS y FROM runs
                 UNION ALL SELECT d.r, coalesce(max(b), 0), any_value(length(h) // 2) FROM d LEFT JOIN runs USING (r) GROUP BY d.r),
        kept AS (SELECT r, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS kept FROM gaps JOIN d USING (r) GROUP BY r),
        total AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(kept)) AS kept_sha256
        FROM d JOIN kept USING (r) LEFT JOIN total USING (r)""",
}
