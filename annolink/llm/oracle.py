"""The same results in DuckDB SQL, where SQL can express them."""

def _leaf(text: str) -> str:
    """The hash of a row of documents."""
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _crc32(text: str) -> str:
    """The CRC-32 of a short text of digits."""
    step = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {codes}), {byte}))"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels above ``leaves`` (tree, n, k, d), and the digests beside each."""
    return f"""
        {name}(level, tree, n, size, k, d) AS (
            SELECT 0, tree, n, n, k, d FROM {leaves}
            UNION ALL
            SELECT level + 1, tree, (n + 15) // 16, size, k // 16, sha256(string_agg(d, '' ORDER BY k))
            FROM {name} WHERE n > 1 GROUP BY level, tree, n, size, k // 16
        ), {name}_beside AS (
            SELECT a.level, a.tree, a.k, coalesce(string_agg(b.d, '' ORDER BY b.k) FILTER (b.k < a.k), '') AS l,
                   coalesce(string_agg(b.d, '' ORDER BY b.k) FILTER (b.k > a.k), '') AS r
            FROM {name} a JOIN {name} b ON a.level = b.level AND a.tree = b.tree AND a.k // 16 = b.k // 16
            WHERE a.n > 1 GROUP BY a.level, a.tree, a.k
        )"""


def _rounds(rounds: int) -> str:
    """Codebooks and assignments of each round, over parts p (v, p, i, x) and entries e0 (p, e, i, x)."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""
        d{r} AS (
            SELECT p.v, p.p, e.e, CAST(sum((p.x - e.x) * (p.x - e.x)) AS BIGINT) AS d
            FROM p JOIN e{r} e ON p.p = e.p AND p.i = e.i GROUP BY p.v, p.p, e.e
        ), a{r} AS (
            SELECT v, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM d{r} GROUP BY v, p
        )""")
        if r < rounds:
            out.append(f"""
        m{r} AS (
            SELECT p.p, a.e, p.i, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS x
            FROM p JOIN a{r} a ON p.v = a.v AND p.p = a.p GROUP BY p.p, a.e, p.i
        ), e{r + 1} AS (
            SELECT e.p, e.e, e.i, coalesce(m.x, e.x) AS x FROM e{r} e LEFT JOIN m{r} m ON e.p = m.p AND e.e = m.e AND e.i = m.i
        )""")
    return ",".join(out)


ORACLE = {
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)
    """,
    # The level of the shares in closed form: sources in order of limit / weight, the level
    # is what the first k at their limit leave to the rest, for the least k that holds.
    "op10_mixing": r"""
        WITH d AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                        || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS k
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
        ), w AS (
            SELECT *, 3.0::DOUBLE * source_size AS most,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
            FROM s
        ), c AS (
            SELECT *, coalesce(sum(most) OVER before, 0) AS held, sum(weight) OVER after AS free,
                   sum(source_size) OVER () AS total
            FROM w WINDOW before AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                          after AS (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), l AS (
            SELECT arg_min((total - held) / free, most / weight) AS level FROM c WHERE (total - held) / free <= most / weight
        ), t AS (
            SELECT source, source_size, CAST(least(most, (SELECT level FROM l) * weight) AS DOUBLE) AS target,
                   CAST(round(least(most, (SELECT level FROM l) * weight)) AS BIGINT) AS budget
            FROM w
        ), p AS (
            SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(budget // source_size * size
                    + greatest(0, least(size, budget % source_size - before)) AS BIGINT) AS taken
        FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
    """,
    "op8_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), t AS (
            SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d WHERE len(w) >= 3
        ), three AS (
            SELECT doc_id, a || ' ' || lead(a) OVER r || ' ' || lead(a, 2) OVER r AS s
            FROM t WINDOW r AS (PARTITION BY doc_id ORDER BY i)
        ), s AS (
            SELECT DISTINCT doc_id, s FROM three WHERE s IS NOT NULL
            UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), e AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
        ), ways AS (
            SELECT a, b FROM e UNION ALL SELECT b, a FROM e
        ), reach(a, b) AS (
            SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
        ), c AS (
            SELECT a, min(b) AS b FROM reach GROUP BY a
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(c.b, d.doc_id), d.doc_id) AS component_id,
               coalesce(least(c.b, d.doc_id), d.doc_id) = d.doc_id AS kept
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
    """,
    "op9_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), t AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
        ), h AS (
            SELECT doc_id, i, md5(string_agg(word, ' ') OVER r) AS h, count(*) OVER r AS n
            FROM t WINDOW r AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
        ), f AS (
            SELECT h, min(doc_id) AS m FROM h WHERE n = 50 GROUP BY h
        ), r AS (
            SELECT h.doc_id, h.i FROM h JOIN f USING (h) WHERE h.n = 50 AND h.doc_id > f.m
        ), c AS (
            SELECT t.doc_id, t.i, t.word, max(CASE WHEN r.i IS NULL THEN 0 ELSE 1 END) OVER (
                   PARTITION BY t.doc_id ORDER BY t.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
            FROM t LEFT JOIN r ON t.doc_id = r.doc_id AND t.i = r.i
        ), k AS (
            SELECT doc_id, sum(gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op11_vector_codes": f"""
        WITH k AS (
            SELECT vec_id, label, embedding AS w FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), n AS (
            SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, w) - 1 AS v FROM k
        ), c AS (
            SELECT v, CAST(floor(256 * CAST(unnest(w) AS DOUBLE)) AS BIGINT) AS x, generate_subscripts(w, 1) - 1 AS i, len(w) // 16 AS width
            FROM n
        ), p AS (
            SELECT v, i // width AS p, i % width AS i, x FROM c
        ), e0 AS (
            SELECT p, v AS e, i, x FROM p WHERE v < 64
        ), {_rounds(2)}, coded AS (
            SELECT v, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY v
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM e2) AS codebooks_sha256
        FROM n JOIN coded USING (v)
    """,
    "op12_merkle_manifest": f"""
        WITH RECURSIVE h AS (
            SELECT doc_id, source, {_leaf("text")} AS leaf,
                   {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed
            FROM documents
        ), sources AS (
            SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)
        ), rows AS (
            SELECT h.*, tree, row_number() OVER g - 1 AS k, count(*) OVER (PARTITION BY tree) AS n
            FROM h JOIN sources ON h.source IS NOT DISTINCT FROM sources.source
            WINDOW g AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)
        ), leaves AS (
            SELECT tree, n, k, leaf AS d FROM rows
        ), {_tree("low", "leaves")}, subroots AS (
            SELECT 0 AS tree, (SELECT count(*) FROM sources) AS n, tree AS k, d FROM low WHERE n = 1
        ), {_tree("high", "subroots")}, steps AS (
            SELECT r.tree, r.k, level, l, b.r FROM rows r JOIN low_beside b ON b.tree = r.tree
                   AND b.k = r.k // CAST(pow(16, level) AS BIGINT)
            UNION ALL
            SELECT r.tree, r.k, 100 + level, l, b.r FROM rows r JOIN high_beside b ON b.k = r.tree // CAST(pow(16, level) AS BIGINT)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree, k ORDER BY level) AS i, count(*) OVER (PARTITION BY tree, k) AS m FROM steps
        ), proofs AS (
            SELECT tree, k, sha256(string_agg(l || r, '' ORDER BY i)) AS proof FROM placed GROUP BY tree, k
        ), hashes AS (
            SELECT tree, k, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN changed ELSE leaf END AS d FROM rows
        ), folds(tree, k, i, d) AS (
            SELECT tree, k, 0, d FROM hashes
            UNION ALL
            SELECT f.tree, f.k, f.i + 1, sha256(p.l || f.d || p.r) FROM folds f JOIN placed p ON p.tree = f.tree AND p.k = f.k AND p.i = f.i + 1
        ), ends AS (
            SELECT tree, k, arg_max(d, i) AS d FROM folds GROUP BY tree, k
        ), root AS (
            SELECT d AS root FROM high WHERE n = 1
        )
        SELECT r.doc_id, r.leaf, s.d AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
               e.d AS folded_root, e.d = root AS verified
        FROM rows r JOIN subroots s ON s.k = r.tree JOIN ends e ON e.tree = r.tree AND e.k = r.k CROSS JOIN root
        LEFT JOIN proofs p ON p.tree = r.tree AND p.k = r.k
    """,
}
