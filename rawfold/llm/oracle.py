"""DuckDB twins of the training-data queries that SQL can express."""

#: lower-case A-Z only: split off the ASCII letters with translate
_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: words: characters that are no ASCII or an ASCII letter or digit
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: crc32 of an ASCII string, byte by byte and bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({s}) + 1), lambda i: ascii({s}[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _repair_sql() -> str:
    """Row by row, for each state (e start, s, u, a) the cheapest edits so far: least of (cost, initials, lines)."""
    def edit(x: str, cost: str, letter: str, line: str | None = None) -> str:
        return (f"{{'c': {x}.c + {cost}, 'p': {x}.p || '{letter}', 'r': "
                + (f"list_append({x}.r, {line})" if line else f"{x}.r") + "}")

    def stay(x: str, role: str | None = None) -> str:  # keep, or give a role; with what a truncated row adds
        cost = f"CASE WHEN gone THEN 1000000 ELSE 3 * cut + {3 if role else 0} END"
        return edit(x, cost, "R" if role else "K", f"'{role}:' || text" if role else "role || ':' || text")

    def keep(x: str, initial: str) -> str:
        return f"CASE WHEN role[1] = '{initial}' THEN {stay(x)} ELSE {none} END"

    none = "{'c': 1000000, 'p': '', 'r': []::VARCHAR[]}"
    put = lambda x, role: edit(x, "3", "I", f"'{role}:'")
    inserts = lambda rows: (
        f"SELECT conv, i, e, s, u, least(a, {put('u', 'assistant')}) AS a FROM "
        f"(SELECT conv, i, e, s, a, least(u, {put('e', 'user')}, {put('s', 'user')}, {put('a', 'user')}) AS u FROM ({rows}))")
    gone = lambda x: edit(x, "4", "D")
    to_u = ", ".join(f"{keep(x, 'u')}, {stay(x, 'user')}" for x in "esa")
    row = f"""SELECT f.conv, f.i + 1 AS i, {gone('e')} AS e, least({gone('s')}, {keep('e', 's')}) AS s,
                     least({gone('u')}, {to_u}) AS u, least({gone('a')}, {keep('u', 'a')}, {stay('u', 'assistant')}) AS a
              FROM f JOIN t ON t.conv IS NOT DISTINCT FROM f.conv AND t.ord = f.i + 1"""
    crc = _CRC32.format(s="(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")
    return rf"""
        WITH RECURSIVE c AS (SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
        d AS (SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                     CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
              FROM c, (VALUES (1), (2)) AS copies(n) WHERE kind <> 0 AND n <= CASE kind WHEN 3 THEN 2 ELSE 1 END),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS ord,
                     NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank FROM d),
        q AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv, role, text ORDER BY ord) > 1 AS twice FROM o),
        t AS (SELECT *, blank OR twice AS gone, (NOT blank AND NOT twice AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$'))::INT AS cut,
                     lag(role[1]) OVER (PARTITION BY conv ORDER BY ord) AS prev FROM q),
        f AS ({inserts(f"SELECT DISTINCT conv, 0::BIGINT AS i, {{'c': 0, 'p': '', 'r': []::VARCHAR[]}} AS e, {none} AS s, {none} AS u, {none} AS a FROM d")}
              UNION ALL {inserts(row)}),
        g AS (SELECT conv, count(*) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (twice) AS duplicate, sum(cut) AS truncated,
                     count(*) FILTER (ord > 1 AND prev || role[1] NOT IN ('su', 'ua', 'au')) AS illegal,
                     coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM t GROUP BY conv),
        w AS (SELECT f.conv, least(e, a) AS best FROM f JOIN g ON f.conv IS NOT DISTINCT FROM g.conv AND f.i = g.n)
        SELECT x.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
               coalesce(best.p, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN g ON x.conv_id IS NOT DISTINCT FROM g.conv
        LEFT JOIN w ON x.conv_id IS NOT DISTINCT FROM w.conv"""


SQL = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY norm)""",
    "op6_decontaminate": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_NORM}, {_WORD}) AS w FROM documents),
        b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_NORM}, {_WORD}) AS w FROM benchmark),
        bw AS (SELECT DISTINCT item, least(10, len(w)) AS l,
                      unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
                                            lambda i: list_slice(w, i, i + least(10, len(w)) - 1))) AS win
               FROM b WHERE len(w) > 0),
        lens AS (SELECT DISTINCT l FROM bw),
        pos AS (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens WHERE len(w) >= l),
        hits AS (SELECT r, i, pos.l, item FROM pos JOIN bw ON pos.l = bw.l AND list_slice(w, i, i + pos.l - 1) = win),
        words AS (SELECT r, count(DISTINCT p) AS n_hit
                  FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hits) GROUP BY r),
        items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
                  FROM hits GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    # the same windows: budget 1024, history 256, 4 tokens a turn
    "op2_chat_format": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                   UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        o AS (SELECT *, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) + 4 AS tok,
                     -- markers, then one more character for each escaped one
                     14 + length(body) + length(role)
                     + 3 * length(body) - length(replace(body, '\', '')) - length(replace(body, '#', '')) - length(replace(body, '</', '<'))
                     + 4 * length(role) - length(replace(role, '\', '')) - length(replace(role, '#', '')) - length(replace(role, '</', '<'))
                     - length(replace(role, ':', '')) AS chars,
                     row_number() OVER w - 1 AS ord FROM t
              WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body)),
        h AS (SELECT conv_id, role = 'system' AS sys, tok AS stok, chars AS schars FROM o WHERE ord = 0),
        s AS (SELECT o.conv_id, ord, tok, chars, greatest(1024 - 256 - CASE WHEN sys THEN stok ELSE 0 END, 64) AS stride,
                     coalesce(sum(tok) OVER (PARTITION BY o.conv_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     AS start FROM o JOIN h ON o.conv_id IS NOT DISTINCT FROM h.conv_id WHERE NOT (sys AND ord = 0)),
        win AS (SELECT *, 2 * (start // stride) + (start + tok > (start // stride + 1) * stride)::INT AS w FROM s),
        ws AS (SELECT conv_id, w, min(start) AS first FROM win GROUP BY ALL),
        again AS (SELECT win.conv_id, sum(chars) AS c FROM ws JOIN win ON ws.conv_id IS NOT DISTINCT FROM win.conv_id
                  AND win.start < first AND win.start >= first - 256 GROUP BY ALL),
        nw AS (SELECT conv_id, count(*) AS n FROM ws GROUP BY ALL),
        c AS (SELECT conv_id, count(*) AS n_turns,
                     sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY ord)) AS turns_sha256,
                     coalesce(sum(length(body)) FILTER (role = 'assistant'), 0) AS loss_chars,
                     sha256(coalesce(string_agg(body, '' ORDER BY ord) FILTER (role = 'assistant'), '')) AS loss_sha256,
                     sum(chars) AS chars FROM o GROUP BY ALL)
        SELECT c.conv_id, n_turns, turns_sha256, loss_chars::BIGINT AS loss_chars, loss_sha256,
               (c.chars + coalesce(again.c, 0) + CASE WHEN sys THEN schars * (coalesce(n, 1) - 1) ELSE 0 END)::BIGINT AS formatted_chars,
               coalesce(n, 1)::BIGINT AS n_windows
        FROM c LEFT JOIN again ON c.conv_id IS NOT DISTINCT FROM again.conv_id
        LEFT JOIN nw ON c.conv_id IS NOT DISTINCT FROM nw.conv_id JOIN h ON c.conv_id IS NOT DISTINCT FROM h.conv_id""",
    "op11_conversation_repair": _repair_sql(),
    "op12_fill_in_middle": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        u AS (SELECT r, doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
                     ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
                     ('0x' || h[25:32])::BIGINT AS h4 FROM d),
        c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
        p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
                     coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                                WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM p""",
    # the same shingles: five words, the first 64 bits of md5, below 2^64 / 8 or else the smallest
    "op13_fingerprints": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
        o AS (SELECT *, coalesce(lead(t) OVER w, first(t) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nt
              FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST)),
        e AS (SELECT row_number() OVER () AS r, *, left(t, n - n // 3) || left(nt, n // 3) AS x FROM o),
        k AS (SELECT r, 'own' AS kind, t FROM e UNION ALL SELECT r, 'edited', x FROM e UNION ALL SELECT r, 'next', nt FROM e),
        w AS (SELECT r, kind, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM k),
        h AS (SELECT r, kind, list_sort(list_distinct(list_transform(list_zip(w, w[2:], w[3:], w[4:], w[5:])[1:CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END],
                     lambda z: md5(concat_ws(' ', z[1], z[2], z[3], z[4], z[5]))[1:16]))) AS h FROM w),
        s AS (SELECT r, kind, CASE WHEN len(list_filter(h, lambda x: x < '2000000000000000')) > 0
                     THEN list_filter(h, lambda x: x < '2000000000000000') ELSE h[1:1] END AS s FROM h),
        p AS (SELECT r, max(s) FILTER (kind = 'own') AS own, max(s) FILTER (kind = 'edited') AS edited, max(s) FILTER (kind = 'next') AS nxt
              FROM s GROUP BY r)
        SELECT doc_id, n::BIGINT AS n_chars, sha256(x) AS edited_sha256, coalesce(array_to_string(own, ''), '') AS fingerprint,
               coalesce(array_to_string(edited, ''), '') AS edited_fingerprint,
               CASE WHEN len(own) + len(edited) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(own, edited))::DOUBLE
                    / (len(own) + len(edited) - len(list_intersect(own, edited))) END AS near_edited,
               CASE WHEN len(own) + len(nxt) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(own, nxt))::DOUBLE
                    / (len(own) + len(nxt) - len(list_intersect(own, nxt))) END AS near_next
        FROM p JOIN e USING (r)""",
}
