"""The queries in plain SQL, written independently of the Spark code, for DuckDB."""

from __future__ import annotations

import re

from annolink.fixed_values import GENE_IDS, KINDS, LATIN_NAMES, SYMBOL_OVERRIDES

# Inputs derived from the given tables; a text refers to them by name.
VIEWS = {
    "mentions_raw": """
        SELECT CASE l_linenumber % 5 WHEN 0 THEN 'genes' WHEN 1 THEN 'species' WHEN 2 THEN 'terms_go'
                    WHEN 3 THEN 'terms_do' ELSE 'terms_chebi' END AS kind,
               concat('Ord-', cast(l_linenumber AS string), '--', cast(l_orderkey AS string)) AS doc_raw,
               CASE l_linenumber % 5 WHEN 0 THEN cast(l_partkey AS string)
                    WHEN 1 THEN cast(l_suppkey AS string)
                    WHEN 2 THEN concat('GO:', lpad(cast(l_partkey % 50 AS string), 7, '0'))
                    WHEN 3 THEN concat('DOID:', cast(l_partkey % 20 AS string))
                    ELSE concat('CHEBI:', cast(l_partkey % 30 AS string)) END AS entity_id,
               CASE WHEN l_quantity = 7 THEN '' ELSE cast(cast(l_quantity AS int) AS string) END AS score
        FROM lineitem""",
    "mentions": r"""
        SELECT kind, regexp_replace(doc_raw, '^.+-([0-9]+)$', '\1') AS doc_id, entity_id,
               coalesce(try_cast(regexp_extract(score, '^\s*([+-]?[0-9]+)', 1) AS int), 0) AS score
        FROM mentions_raw""",
    "kept": "SELECT * FROM mentions WHERE score >= 3",
    "entity_labels": """
        SELECT 'genes' AS kind, cast(p_partkey AS string) AS entity_id, p_name AS name FROM part WHERE p_partkey % 10 <> 0
        UNION ALL SELECT 'species', cast(s_suppkey AS string),
               CASE WHEN s_suppkey % 3 = 0 THEN 'Genus' ELSE replace(s_name, '#', ' ') END FROM supplier
        UNION ALL SELECT 'terms_go', concat('GO:', lpad(cast(p_partkey AS string), 7, '0')), p_name FROM part WHERE p_partkey < 45
        UNION ALL SELECT 'terms_do', concat('DOID:', cast(p_partkey AS string)), p_type FROM part WHERE p_partkey < 20
        UNION ALL SELECT 'terms_chebi', concat('CHEBI:', cast(p_partkey AS string)), p_brand FROM part WHERE p_partkey < 30""",
    "labelled": """
        SELECT m.kind, m.doc_id, l.name, m.entity_id, m.score
        FROM kept m JOIN entity_labels l ON m.kind = l.kind AND m.entity_id = l.entity_id""",
    "facts": """
        SELECT DISTINCT kind, concat('PMC', doc_id) AS doc_id, name, entity_id, score FROM labelled""",
    "taxonomy": """
        SELECT CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE replace(s_name, '#', ' ') END AS name,
               cast(s_suppkey AS string) AS taxon_id FROM supplier
        UNION ALL SELECT concat('Alias ', cast(s_suppkey AS string)), cast(s_suppkey AS string)
        FROM supplier WHERE s_suppkey % 2 = 0""",
    "species_dictionary": "SELECT name FROM taxonomy WHERE cast(taxon_id AS int) % 4 <> 1",
    "whitelist": """
        SELECT DISTINCT t.name, t.taxon_id FROM taxonomy t JOIN species_dictionary d ON t.name = d.name
        WHERE regexp_matches(t.name, '.+ [^ ]')""",
    "listed_species": """
        SELECT * FROM kept WHERE kind = 'species' AND entity_id IN (SELECT taxon_id FROM whitelist)""",
    "gene_taxon": """
        SELECT concat(substring(p_brand, 7), '|', cast(p_partkey AS string)) AS taxon_gene FROM part""",
    "taxon_genes": """
        SELECT DISTINCT split_part(taxon_gene, '|', 2) AS entity_id FROM gene_taxon
        WHERE split_part(taxon_gene, '|', 1) = '2'""",
    "dim_pmid": "SELECT cast(o_orderkey AS string) AS doc_id, cast(10000000 + o_orderkey AS string) AS pmid FROM orders WHERE o_orderkey % 11 <> 0",
    "dim_doi": "SELECT cast(o_orderkey AS string) AS doc_id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat('10.1/', cast(o_orderkey AS string)) END AS doi FROM orders",
    "dim_title": "SELECT cast(o_orderkey AS string) AS doc_id, concat('Order ', cast(o_orderkey AS string), ' ', o_orderpriority) AS title FROM orders",
    "dim_journal": "SELECT cast(o_orderkey AS string) AS doc_id, c_mktsegment AS journal FROM orders JOIN customer ON o_custkey = c_custkey",
    "dim_year": "SELECT cast(o_orderkey AS string) AS doc_id, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE cast(year(o_orderdate) AS string) END AS year FROM orders",
    "attributes": """
        SELECT DISTINCT doc_id, pmid, doi, title, journal, year
        FROM dim_pmid JOIN dim_doi USING (doc_id) JOIN dim_title USING (doc_id)
        JOIN dim_journal USING (doc_id) JOIN dim_year USING (doc_id)""",
    "list_texts": """
        SELECT doc_id, kind, string_agg(concat(name, '@!@', entity_id, '@!@', cast(score AS string)), '#!#'
                                        ORDER BY score DESC, name, entity_id) AS entries
        FROM labelled GROUP BY doc_id, kind""",
    "list_table": """
        SELECT doc_id,
               coalesce(max(entries) FILTER (WHERE kind = 'genes'), '') AS genes,
               coalesce(max(entries) FILTER (WHERE kind = 'species'), '') AS species,
               coalesce(max(entries) FILTER (WHERE kind = 'terms_go'), '') AS terms_go,
               coalesce(max(entries) FILTER (WHERE kind = 'terms_do'), '') AS terms_do,
               coalesce(max(entries) FILTER (WHERE kind = 'terms_chebi'), '') AS terms_chebi
        FROM list_texts GROUP BY doc_id""",
    "fact_texts": """
        SELECT doc_id, kind, string_agg(concat(name, '@!@', entity_id, '@!@', cast(score AS string)), '#!#'
                                        ORDER BY score DESC, name, entity_id) AS entries
        FROM facts GROUP BY doc_id, kind""",
    "fact_lists": """
        SELECT doc_id, max(entries) FILTER (WHERE kind = 'genes') AS genes,
               max(entries) FILTER (WHERE kind = 'species') AS species,
               max(entries) FILTER (WHERE kind = 'terms_go') AS terms_go,
               max(entries) FILTER (WHERE kind = 'terms_do') AS terms_do,
               max(entries) FILTER (WHERE kind = 'terms_chebi') AS terms_chebi
        FROM fact_texts GROUP BY doc_id""",
    "combined": """
        SELECT doc_id, gene_id, gene_score, species_id, species_score, go_id, go_score,
               do_id, do_score, chebi_id, chebi_score
        FROM (SELECT doc_id, entity_id AS gene_id, score AS gene_score FROM kept WHERE kind = 'genes')
        FULL JOIN (SELECT doc_id, entity_id AS species_id, score AS species_score FROM kept WHERE kind = 'species') USING (doc_id)
        FULL JOIN (SELECT doc_id, entity_id AS go_id, score AS go_score FROM kept WHERE kind = 'terms_go') USING (doc_id)
        FULL JOIN (SELECT doc_id, entity_id AS do_id, score AS do_score FROM kept WHERE kind = 'terms_do') USING (doc_id)
        FULL JOIN (SELECT doc_id, entity_id AS chebi_id, score AS chebi_score FROM kept WHERE kind = 'terms_chebi') USING (doc_id)""",
    "wide": """
        SELECT c.doc_id, g.name AS gene_name, gene_id, gene_score, s.name AS species_name, species_id, species_score,
               o.name AS go_name, go_id, go_score, d.name AS do_name, do_id, do_score,
               h.name AS chebi_name, chebi_id, chebi_score
        FROM combined c
        LEFT JOIN entity_labels g ON g.kind = 'genes' AND g.entity_id = gene_id
        LEFT JOIN entity_labels s ON s.kind = 'species' AND s.entity_id = species_id
        LEFT JOIN entity_labels o ON o.kind = 'terms_go' AND o.entity_id = go_id
        LEFT JOIN entity_labels d ON d.kind = 'terms_do' AND d.entity_id = do_id
        LEFT JOIN entity_labels h ON h.kind = 'terms_chebi' AND h.entity_id = chebi_id
        WHERE (gene_id IS NULL OR g.name IS NOT NULL) AND (species_id IS NULL OR s.name IS NOT NULL)
          AND (go_id IS NULL OR o.name IS NOT NULL) AND (do_id IS NULL OR d.name IS NOT NULL)
          AND (chebi_id IS NULL OR h.name IS NOT NULL)""",
    "ranked": """
        SELECT doc_id, kind, row_number() OVER (PARTITION BY doc_id, kind ORDER BY score DESC, name, entity_id) - 1 AS rank,
               name, entity_id, score
        FROM labelled""",
    "gold": "SELECT DISTINCT l_suppkey AS query_key, l_orderkey AS doc_id FROM lineitem WHERE l_returnflag = 'R'",
    "found": "SELECT DISTINCT l_suppkey AS query_key, l_orderkey AS doc_id FROM lineitem WHERE l_quantity >= 25",
    "counts": """
        SELECT query_key, count(g) AS gold, count(f) AS found, count(g + f) AS tp,
               count(f) - count(g + f) AS fp, count(g) - count(g + f) AS fn
        FROM (SELECT *, 1 AS g FROM gold) FULL JOIN (SELECT *, 1 AS f FROM found) USING (query_key, doc_id)
        GROUP BY query_key""",
    "result_a": """
        SELECT doi, year FROM dim_doi JOIN dim_year USING (doc_id)
        WHERE doc_id IN (SELECT cast(o_orderkey AS string) FROM orders WHERE year(o_orderdate) = 1997)""",
    "result_b": """
        SELECT doi, year FROM dim_doi JOIN dim_year USING (doc_id)
        WHERE doc_id IN (SELECT cast(o_orderkey AS string) FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "lookup": """
        SELECT CASE kind WHEN 'genes' THEN 'gene' WHEN 'terms_go' THEN 'go' WHEN 'terms_do' THEN 'do'
                    WHEN 'terms_chebi' THEN 'chebi' ELSE kind END AS short,
               doc_id, name, entity_id, score FROM facts""",
    "searchable": """
        SELECT concat(short, '_name') AS attr, name AS value FROM lookup
        UNION SELECT concat(short, '_id'), entity_id FROM lookup
        UNION SELECT 'doc_id', doc_id FROM facts""",
    "typed": """
        SELECT DISTINCT trim(t) AS text FROM (
            SELECT substring(v, 1, n) AS t FROM (
                SELECT name AS v FROM entity_labels UNION SELECT entity_id FROM entity_labels), range(2, 7) r(n))
        WHERE length(trim(t)) >= 2""",
    "word_items": """
        SELECT DISTINCT doc_id, unnest(words) AS item FROM document_words""",
    "tx_words": """
        SELECT doc_id, item FROM word_items WHERE item IN (
            SELECT item FROM (SELECT item, count(*) AS n FROM word_items GROUP BY item
                              ORDER BY n DESC, item DESC LIMIT 100))""",
    "ranked_entities": """
        SELECT kind, entity_id, row_number() OVER (PARTITION BY kind ORDER BY n DESC, entity_id DESC) AS place
        FROM (SELECT kind, entity_id, count(*) AS n FROM labelled
              WHERE kind <> 'species' AND (kind <> 'genes' OR entity_id IN (SELECT entity_id FROM taxon_genes))
              GROUP BY kind, entity_id)""",
    "tx_entities": """
        SELECT DISTINCT doc_id, name AS item FROM labelled
        WHERE (kind, entity_id) IN (SELECT (kind, entity_id) FROM ranked_entities WHERE place <= 100)""",
    "benchmark_words": r"""
        SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+', 0) AS words FROM benchmark""",
    "word_dictionary": """
        SELECT DISTINCT name FROM (SELECT unnest(words) AS name FROM benchmark_words)
        UNION SELECT concat(words[i], ' ', words[i + 1])
        FROM (SELECT words, unnest(range(1, len(words))) AS i FROM benchmark_words)""",
    "document_words": r"""
        SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+', 0) AS words FROM documents""",
    "phrases": """
        SELECT doc_id, unnest(words) AS phrase FROM document_words
        UNION ALL SELECT doc_id, concat(words[i], ' ', words[i + 1])
        FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM document_words)""",
    "listed_rows": """
        SELECT * FROM kept WHERE kind <> 'species' UNION ALL SELECT * FROM listed_species""",
    "readable_labels": """
        SELECT * FROM entity_labels WHERE kind <> 'species' OR regexp_matches(name, '.+ [^ ]')""",
}

_METRICS = """
    CASE WHEN found = 0 OR gold = 0 THEN 0 ELSE 1000 * tp // found END AS "precision",
    CASE WHEN found = 0 OR gold = 0 THEN 0 ELSE 1000 * tp // gold END AS recall"""


def _metrics(counts: str) -> str:
    return f"""
        SELECT *, CASE WHEN "precision" + recall = 0 THEN 0
                       ELSE ((2 * "precision" * recall) // 1000) * 1000 // ("precision" + recall) END AS f1,
               CASE WHEN tp + fn = 0 THEN 0 ELSE 1000 * tp // (tp + fn) END AS tpr,
               CASE WHEN tp + fp = 0 THEN 0 ELSE 1000 * fp // (tp + fp) END AS fdr
        FROM (SELECT *, {_METRICS} FROM {counts})"""


def _rules(tx: str, confidence: str) -> str:
    return f"""
        SELECT a.item AS lhs, b.item AS rhs, count(*) / any_value(t.n) AS support,
               count(*) / any_value(ca.n) AS confidence,
               count(*) * any_value(t.n) / (any_value(ca.n) * any_value(cb.n)) AS lift, count(*) AS n_both
        FROM {tx} a JOIN {tx} b ON a.doc_id = b.doc_id AND a.item <> b.item
        JOIN (SELECT item, count(*) AS n FROM {tx} GROUP BY item) ca ON ca.item = a.item
        JOIN (SELECT item, count(*) AS n FROM {tx} GROUP BY item) cb ON cb.item = b.item
        CROSS JOIN (SELECT count(DISTINCT doc_id) AS n FROM {tx}) t
        GROUP BY a.item, b.item
        HAVING count(*) / any_value(t.n) >= 0.0001 AND count(*) / any_value(ca.n) >= {confidence}"""


def _cut(n: int, m: int) -> str:
    return f"""
        SELECT '{n}/{m}' AS share, v AS cut_value
        FROM (SELECT cast(l_quantity AS int) AS v, row_number() OVER (ORDER BY l_quantity DESC) AS place FROM lineitem)
        WHERE place = (SELECT greatest(1, count(*) FILTER (WHERE l_quantity <> 1) * {n} // {m}) FROM lineitem)"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


_TERMS = f"""
        WITH n(species, latin_name, filter_name) AS (VALUES {_values(LATIN_NAMES)}),
             g(gene, species, gene_id) AS (VALUES {_values(GENE_IDS)}),
             o(gene, species, symbol) AS (VALUES {_values(SYMBOL_OVERRIDES)}),
             r AS (SELECT s_suppkey, ['BRCA2', 'Myc', 'APC', 'DCC'][s_suppkey % 4 + 1] AS gene,
                          [{", ".join(f"'{n[0]}'" for n in LATIN_NAMES)}, 'other'][s_nationkey % 5 + 1] AS species
                   FROM supplier)
        SELECT s_suppkey, r.gene, r.species, lower(coalesce(o.symbol, r.gene)) AS symbol,
               latin_name, filter_name, gene_id
        FROM r LEFT JOIN n USING (species) LEFT JOIN g ON r.gene = g.gene AND r.species = g.species
        LEFT JOIN o ON r.gene = o.gene AND r.species = o.species"""


def _stats(strict: str) -> str:
    def figure(label, what, where="TRUE"):
        return f"SELECT '{label}' AS figure, count(DISTINCT {what}) AS value FROM labelled WHERE {where}"

    onto = "kind IN ('terms_go', 'terms_do', 'terms_chebi')"
    return "\nUNION ALL ".join(
        [
            figure("publications", "doc_id"),
            figure("publications with genes", "doc_id", f"kind = 'genes' AND {strict}"),
            figure("publications with species", "doc_id", f"kind = 'species' AND {strict}"),
            figure("publications with terms", "doc_id", onto),
            figure("distinct genes", "entity_id", f"kind = 'genes' AND {strict}"),
            figure("distinct species", "entity_id", f"kind = 'species' AND {strict}"),
            figure("distinct terms_go", "entity_id", "kind = 'terms_go'"),
            figure("distinct terms_do", "entity_id", "kind = 'terms_do'"),
            figure("distinct terms_chebi", "entity_id", "kind = 'terms_chebi'"),
            figure("distinct ontology terms", "(kind, entity_id)", onto),
        ]
    )


def _find(hits: str, kind: str, offset: int) -> str:
    return f"""
        SELECT m.doc_id, best_score, pmid, doi, title, journal, year, count(*) OVER () AS total
        FROM ({hits}) m
        JOIN (SELECT doc_id, max(score) AS best_score FROM facts WHERE kind = '{kind}' GROUP BY doc_id) b ON b.doc_id = m.doc_id
        JOIN attributes a ON concat('PMC', a.doc_id) = m.doc_id
        ORDER BY best_score DESC, m.doc_id LIMIT 25 OFFSET {offset}"""


def _find_listed(hits: str, kind: str, offset: int, filled: str = "TRUE") -> str:
    return f"""
        SELECT m.doc_id, best_score, pmid, doi, title, journal, year, count(*) OVER () AS total,
               coalesce(genes, '') AS genes, coalesce(species, '') AS species, coalesce(terms_go, '') AS terms_go,
               coalesce(terms_do, '') AS terms_do, coalesce(terms_chebi, '') AS terms_chebi
        FROM ({hits}) m
        JOIN (SELECT doc_id, max(score) AS best_score FROM facts WHERE kind = '{kind}' GROUP BY doc_id) b ON b.doc_id = m.doc_id
        JOIN attributes a ON concat('PMC', a.doc_id) = m.doc_id
        LEFT JOIN fact_lists l ON l.doc_id = m.doc_id
        WHERE {filled}
        ORDER BY best_score DESC, m.doc_id LIMIT 25 OFFSET {offset}"""


_LINKS = """CASE kind
    WHEN 'genes' THEN concat('http://www.ncbi.nlm.nih.gov/gene/', entity_id)
    WHEN 'species' THEN concat('http://www.ncbi.nlm.nih.gov/Taxonomy/Browser/wwwtax.cgi?mode=Info&id=', entity_id)
    WHEN 'terms_go' THEN concat('http://amigo.geneontology.org/cgi-bin/amigo/term_details?term=', entity_id)
    WHEN 'terms_do' THEN concat('http://www.ebi.ac.uk/ontology-lookup/browse.do?ontName=DOID&termId=DOID%3A',
                                regexp_replace(entity_id, '^[^:]+:', ''))
    ELSE concat('http://www.ebi.ac.uk/chebi/searchId.do?chebiId=', entity_id) END"""

_BAND = "greatest(5, least(15, score >> 1))"

_SEARCH = ", ".join(
    f"CASE WHEN regexp_matches({s}_name, '[A-Za-z0-9]') THEN lower({s}_name) ELSE '' END AS {s}_search"
    for s in ("gene", "species", "go", "do", "chebi")
)

_ROUTED = """
    attr = 'gene_name'
    OR (attr = 'doc_id' AND regexp_full_match(upper(text), 'P|PM|PMC|PMC[0-9]+'))
    OR (attr IN ('species_name', 'go_name', 'do_name', 'chebi_name') AND regexp_matches(upper(text), '^[A-Z]'))
    OR (attr IN ('gene_id', 'species_id') AND regexp_full_match(text, '[0-9]+'))
    OR (attr = 'go_id' AND regexp_full_match(upper(text), 'G|GO|GO:|GO:[0-9]+'))
    OR (attr = 'do_id' AND regexp_full_match(upper(text), 'D|DO|DO:|DOI:|DOID:|DOID:[0-9]+'))
    OR (attr = 'chebi_id' AND regexp_full_match(upper(text), 'C|CH|CHE:|CHEB:|CHEBI:|CHEBI:[0-9]+'))"""

_HITS_A = """SELECT doc_id FROM facts WHERE kind = 'genes' AND name = 'small ring'
             INTERSECT SELECT doc_id FROM facts WHERE kind = 'terms_do' AND name = 'PROMO'"""
_HITS_B = """SELECT doc_id FROM facts WHERE kind = 'terms_go' AND name = 'small ring'
             INTERSECT SELECT doc_id FROM facts WHERE kind = 'terms_do' AND name = 'PROMO'"""

_GENE_PREFIX = """SELECT name AS value, doc_id, entity_id, score FROM facts
                  WHERE kind = 'genes' AND starts_with(lower(name), 'sm')"""

_BODIES = {
    "normalise_doc_id": "SELECT doc_raw, split_part(doc_raw, '--', 2) AS doc_id FROM mentions_raw",
    "lenient_int": """SELECT doc_raw, coalesce(try_cast(score AS int), 0) AS score,
                             coalesce(try_cast(score AS int), 0) AS score_with_rest FROM mentions_raw""",
    "default_score": "SELECT doc_raw, CASE WHEN score = '' THEN '0' ELSE score END AS score FROM mentions_raw",
    "with_id_prefix": "SELECT DISTINCT concat('PMC', doc_id) AS doc_id FROM mentions",
    "score_band": f"SELECT {_BAND} AS band, count(*) AS n FROM labelled GROUP BY 1",
    "link_out": f"SELECT kind, entity_id, {_LINKS} AS link FROM entity_labels",
    "document_links": """
        SELECT doc_id, CASE WHEN pmid IS NOT NULL THEN concat('http://www.ncbi.nlm.nih.gov/pmc/articles/', doc_id)
                            ELSE concat('doi://', doi) END AS link
        FROM dim_doi LEFT JOIN dim_pmid USING (doc_id)""",
    "year_of": "SELECT o_orderkey, cast(year(o_orderdate) AS string) AS year FROM orders",
    "recode": """
        SELECT p_partkey, p_brand, p_type,
               CASE WHEN count(*) OVER (PARTITION BY p_brand, p_type) >= 5
                    THEN concat(p_brand, '-', p_type) ELSE p_name END AS p_name
        FROM part""",
    "expand_synonyms": """
        SELECT cast(p_partkey AS string) AS entity_id, p_name AS synonym FROM part
        UNION ALL SELECT cast(p_partkey AS string), p_brand FROM part
        UNION ALL SELECT cast(p_partkey AS string), p_type FROM part""",
    "extract_ids": r"""
        SELECT DISTINCT concat('PMC', unnest(regexp_extract_all(html, 'track\(([0-9]+)\)', 1))) AS doc_id FROM pages""",
    "cut_below": "SELECT * FROM kept",
    "multiword_names": "SELECT name, taxon_id FROM taxonomy WHERE regexp_matches(name, '.+ [^ ]')",
    "valid_rows": """
        SELECT kind, concat('PMC', split_part(doc_raw, '--', 2)) AS doc_id, '' AS name, entity_id, score
        FROM mentions_raw""",
    "by_entity": "SELECT * FROM labelled WHERE entity_id = 'DOID:12'",
    "for_taxon": "SELECT entity_id FROM taxon_genes",
    "published_until": "SELECT o_orderkey FROM orders WHERE o_orderdate <= DATE '2000-08-15'",
    "label_mentions": "SELECT * FROM labelled",
    "species_whitelist": "SELECT * FROM listed_species",
    "species_whitelist_multiplicity": """
        SELECT k.* FROM kept k JOIN whitelist w ON k.entity_id = w.taxon_id WHERE kind = 'species'""",
    "combine_kinds": "SELECT * FROM combined",
    "label_wide": "SELECT * FROM wide",
    "search_columns": f"SELECT *, {_SEARCH} FROM wide",
    "combination_counts": "SELECT doc_id, cast(count(*) AS decimal(38, 0)) AS n_rows FROM combined GROUP BY doc_id",
    "combinations_of_entries": "\nUNION ALL ".join(
        f"SELECT '{kind}' AS kind, {s}_id AS entity_id, cast(count(*) AS decimal(38, 0)) AS n_rows FROM wide WHERE {s}_id IS NOT NULL GROUP BY {s}_id"
        for kind, s in KINDS.items()
    ),
    "wide_rows_found": f"""
        SELECT *, {_SEARCH} FROM wide WHERE starts_with(lower(do_name), 'promo') AND go_score >= 25""",
    "publication_attributes": "SELECT * FROM attributes WHERE doc_id IN (SELECT doc_id FROM kept)",
    "publication_attributes_left": """
        SELECT DISTINCT doc_id, pmid, doi, title, journal, year FROM (SELECT DISTINCT doc_id FROM kept)
        LEFT JOIN dim_pmid USING (doc_id) LEFT JOIN dim_doi USING (doc_id) LEFT JOIN dim_title USING (doc_id)
        LEFT JOIN dim_journal USING (doc_id) LEFT JOIN dim_year USING (doc_id)""",
    "overlap": """
        SELECT count(a) - count(a || b) AS only_a, count(b) - count(a || b) AS only_b, count(a || b) AS both
        FROM (SELECT DISTINCT doi, 'a' AS a FROM result_a WHERE doi <> '')
        FULL JOIN (SELECT DISTINCT doi, 'b' AS b FROM result_b WHERE doi <> '') USING (doi)""",
    "entity_frequency": "SELECT kind, entity_id, count(*) AS n FROM labelled GROUP BY kind, entity_id",
    "entity_lists": "SELECT *, 0 AS part FROM list_table",
    "ranked_entries": "SELECT * FROM ranked",
    "entity_list_parts": """
        SELECT doc_id, part,
               coalesce(max(entry) FILTER (WHERE kind = 'genes'), '') AS genes,
               coalesce(max(entry) FILTER (WHERE kind = 'species'), '') AS species,
               coalesce(max(entry) FILTER (WHERE kind = 'terms_go'), '') AS terms_go,
               coalesce(max(entry) FILTER (WHERE kind = 'terms_do'), '') AS terms_do,
               coalesce(max(entry) FILTER (WHERE kind = 'terms_chebi'), '') AS terms_chebi
        FROM (SELECT doc_id, cast(rank AS int) AS part, kind, concat(name, '@!@', entity_id, '@!@', cast(score AS string)) AS entry
              FROM ranked WHERE rank >= 1)
        GROUP BY doc_id, part""",
    "publication_table": """
        SELECT a.*, coalesce(genes, '') AS genes, coalesce(species, '') AS species, coalesce(terms_go, '') AS terms_go,
               coalesce(terms_do, '') AS terms_do, coalesce(terms_chebi, '') AS terms_chebi, 0 AS part
        FROM attributes a LEFT JOIN list_table USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM kept)""",
    "decode_lists": f"""
        SELECT doc_id, kind,
               row_number() OVER (PARTITION BY doc_id, kind ORDER BY score DESC, name, entity_id) - 1 AS rank,
               name, entity_id, score, {_BAND} AS band, {_LINKS} AS link,
               (kind = 'genes' AND name = 'small ring') OR (kind = 'terms_do' AND entity_id = 'DOID:12') AS is_selected
        FROM labelled""",
    "distinct_counts": """
        SELECT kind, count(DISTINCT doc_id) AS n_documents, count(DISTINCT entity_id) AS n_entities
        FROM labelled GROUP BY kind""",
    "approximate_counts": """
        SELECT DISTINCT kind, TRUE AS documents_close, TRUE AS entities_close FROM labelled""",
    "release_stats": _stats("TRUE")
    + """
        UNION ALL SELECT concat('documents with ', kind), count(DISTINCT doc_id) FROM labelled GROUP BY kind
        UNION ALL SELECT concat('entities of ', kind), count(DISTINCT entity_id) FROM labelled GROUP BY kind""",
    "batches_replaced": """
        SELECT concat('b', right(doc_id, 1)) AS batch, * FROM facts
        WHERE right(doc_id, 1) <> '2' AND (right(doc_id, 1) <> '1' OR kind <> 'genes')""",
    "batch_list": """
        SELECT concat('b', right(doc_id, 1)) AS batch, count(*) FILTER (WHERE right(doc_id, 1) <> '2') AS n_facts
        FROM facts GROUP BY ALL""",
    "sketched_stats": f"SELECT figure, TRUE AS close FROM ({_stats('TRUE')})",
    "evaluation_terms": _TERMS,
    "refuse_then_replace": "SELECT kind, doc_id, name, entity_id, score FROM labelled WHERE kind = 'species'",
    "corpus_stats": _stats("TRUE"),
    "corpus_stats_strict": _stats("regexp_matches(entity_id, '^[1-9][0-9]')"),
    "cut_value": "\nUNION ALL ".join(_cut(n, m) for n, m in ((1, 4), (1, 2), (3, 4))),
    "year_histogram": """
        SELECT y AS year, (SELECT count(*) FROM result_a WHERE year = y) AS n_a,
               (SELECT count(*) FROM result_b WHERE year = y) AS n_b
        FROM (SELECT cast(unnest(range(1993, 2004)) AS string) AS y)
        UNION ALL
        SELECT 'no e-publication date', (SELECT count(*) FROM result_a WHERE year = ''),
               (SELECT count(*) FROM result_b WHERE year = '')""",
    "confusion": "SELECT * FROM counts",
    "evaluation_metrics": _metrics("counts"),
    "association_rules": _rules("tx_words", "0.95"),
    "top_entities": """
        SELECT kind, entity_id, count(*) AS n FROM labelled WHERE kind = 'genes'
        GROUP BY kind, entity_id ORDER BY n DESC, entity_id DESC LIMIT 100""",
    "top_entities_taxon": """
        SELECT kind, entity_id, count(*) AS n FROM labelled
        WHERE kind = 'genes' AND entity_id IN (SELECT entity_id FROM taxon_genes)
        GROUP BY kind, entity_id ORDER BY n DESC, entity_id DESC LIMIT 100""",
    "union_batches": "SELECT * FROM kept UNION ALL SELECT * FROM listed_species",
    "facts": "SELECT * FROM facts",
    "document_ids": "SELECT DISTINCT doc_id FROM kept",
    "document_ids_labelled": "SELECT DISTINCT doc_id FROM labelled",
    "intersect_ids": "SELECT * FROM gold INTERSECT SELECT * FROM found",
    "except_ids": "SELECT * FROM gold EXCEPT SELECT * FROM found",
    "false_negatives": "SELECT query_key, doc_id FROM gold EXCEPT SELECT query_key, doc_id FROM found",
    "restrict_to": """
        SELECT * FROM gold WHERE doc_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""",
    "prefix_lookup": _GENE_PREFIX,
    "suggest": """
        SELECT attr, value FROM searchable
        WHERE attr IN ('gene_name', 'species_name', 'go_name', 'do_name', 'chebi_name') AND starts_with(lower(value), 'sm')
        QUALIFY row_number() OVER (PARTITION BY attr ORDER BY value) <= 5""",
    "suggest_batch": f"""
        SELECT text, attr, value FROM typed JOIN searchable ON starts_with(lower(value), lower(text))
        WHERE {_ROUTED}
        QUALIFY row_number() OVER (PARTITION BY text, attr ORDER BY value) <= 5""",
    "find_documents": _find(_HITS_A, "genes", 0),
    "find_documents_page": _find(_HITS_B, "terms_do", 25),
    "find_documents_indexed": _find_listed(_HITS_B, "terms_do", 0, "doi <> ''"),
    "find_documents_seek": _find_listed(_HITS_B, "terms_do", 25),
    "index_postings": """
        SELECT attr, value, count(*) AS n FROM (
            SELECT DISTINCT concat(short, '_name') AS attr, name AS value, doc_id FROM lookup
            UNION ALL SELECT DISTINCT concat(short, '_id'), entity_id, doc_id FROM lookup
            UNION ALL SELECT DISTINCT 'doc_id', doc_id, doc_id FROM facts
            UNION ALL SELECT 'filled', k, concat('PMC', doc_id) FROM (
                SELECT doc_id, unnest(['doc_id', 'pmid', 'doi', 'title', 'journal', 'year']) AS k,
                       unnest([doc_id, pmid, doi, title, journal, year]) AS v FROM attributes) WHERE v <> '')
        WHERE substr(doc_id, 4) IN (SELECT doc_id FROM attributes) AND doc_id IN (SELECT doc_id FROM facts)
        GROUP BY attr, value""",
    "documents_of": """
        SELECT doc_id, string_agg(concat(name, '@!@', entity_id, '@!@', cast(score AS string)), '#!#'
                                  ORDER BY score DESC, name, entity_id) AS entities
        FROM facts WHERE kind = 'genes' AND entity_id IN ('12', '675') GROUP BY doc_id""",
    "lookup_batch": """
        SELECT DISTINCT concat(kind, '/', entity_id) AS query_key, doc_id FROM facts""",
    "transactions": "SELECT * FROM tx_entities",
    "tag_documents": """
        SELECT 'terms_go' AS kind, doc_id, phrase AS entity_id, cast(count(*) AS int) AS score
        FROM phrases JOIN word_dictionary ON phrase = name GROUP BY doc_id, phrase""",
    "assign_batches": """
        SELECT source, doc_id, (row_number() OVER (ORDER BY source, doc_id) - 1) // 200 AS batch FROM documents""",
    "mentions_roundtrip": """
        SELECT kind, 'all' AS batch, doc_raw, entity_id, nullif(score, '') AS score FROM mentions_raw""",
    "dictionaries_roundtrip": "SELECT * FROM entity_labels",
    "taxonomy_roundtrip": "SELECT name, taxon_id FROM taxonomy",
    "gene_taxon_roundtrip": """
        SELECT substring(p_brand, 7) AS taxon, cast(p_partkey AS string) AS entity_id FROM part""",
    "publications_roundtrip": "SELECT * FROM attributes WHERE doc_id IN (SELECT doc_id FROM kept)",
    "id_list_roundtrip": "SELECT DISTINCT cast(l_orderkey AS string) AS doc_id FROM lineitem",
    "transactions_roundtrip": "SELECT DISTINCT doc_id, name AS item FROM labelled",
    "evaluation_roundtrip": f"""
        SELECT cast(query_key AS string) AS gene, gold, found, tp, fp, fn, "precision", recall, f1, tpr, fdr
        FROM ({_metrics("counts")})""",
    "corpus_roundtrip": "SELECT * FROM labelled",
    "export_roundtrip": "SELECT * FROM labelled",
    "lookup_roundtrip": _GENE_PREFIX,
    "build_corpus": """
        SELECT a.*, coalesce(genes, '') AS genes, coalesce(species, '') AS species, coalesce(terms_go, '') AS terms_go,
               coalesce(terms_do, '') AS terms_do, coalesce(terms_chebi, '') AS terms_chebi, 0 AS part
        FROM attributes a LEFT JOIN list_table USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM kept)""",
    "build_wide": f"SELECT *, {_SEARCH} FROM wide",
    "build_wide_publications": "SELECT * FROM attributes WHERE doc_id IN (SELECT doc_id FROM kept)",
    "build_wide_counts": "SELECT doc_id, cast(count(*) AS decimal(38, 0)) AS n_rows FROM wide GROUP BY doc_id",
    "mine_rules": _rules("tx_entities", "0.3"),
    "strong_rules": f"SELECT * FROM ({_rules('tx_entities', '0.05')}) WHERE support >= 0.01",
    "evaluate_service": _metrics("service_counts"),
    "evaluate_genes": f"""
        SELECT m.*, gene, species, symbol, latin_name, filter_name
        FROM ({_metrics("gene_counts")}) m JOIN gene_terms ON s_suppkey = query_key""",
    "compare_services": """
        SELECT 'in_a' AS source, count(*) AS n FROM result_a UNION ALL SELECT 'in_b', count(*) FROM result_b""",
}

# The two corpus jobs filter species by the whitelist and by readable labels first.
_JOB_VIEWS = {
    "build_corpus": {
        "kept": "SELECT * FROM mentions WHERE score >= 3 AND (kind <> 'species' OR entity_id IN (SELECT taxon_id FROM whitelist))",
        "labelled": VIEWS["labelled"].replace("entity_labels", "readable_labels"),
    },
    "build_wide": {
        "kept": "SELECT * FROM mentions WHERE score >= 3 AND (kind <> 'species' OR entity_id IN (SELECT taxon_id FROM whitelist))",
        "wide": VIEWS["wide"].replace("entity_labels", "readable_labels"),
    },
    "evaluate_service": {
        "service_gold": """
            SELECT DISTINCT concat('species/', cast(l_suppkey AS string)) AS query_key, concat('PMC', cast(l_orderkey AS string)) AS doc_id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE l_returnflag = 'R' AND o_orderstatus <> 'P' AND o_orderdate <= DATE '2000-08-15'""",
        "service_found": "SELECT DISTINCT concat('species/', entity_id) AS query_key, doc_id FROM facts WHERE kind = 'species'",
        "service_counts": """
            SELECT query_key, count(g) AS gold, count(f) AS found, count(g + f) AS tp,
                   count(f) - count(g + f) AS fp, count(g) - count(g + f) AS fn
            FROM (SELECT *, 1 AS g FROM service_gold) FULL JOIN (SELECT *, 1 AS f FROM service_found) USING (query_key, doc_id)
            GROUP BY query_key""",
    },
}


_JOB_VIEWS["evaluate_genes"] = {
    "gene_terms": _TERMS,
    "gene_gold": """
        SELECT DISTINCT l_suppkey AS query_key, concat('PMC', cast(l_orderkey AS string)) AS doc_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND o_orderstatus <> 'P' AND o_orderdate <= DATE '2000-08-15'""",
    "gene_found": """
        SELECT DISTINCT s_suppkey AS query_key, doc_id FROM gene_terms JOIN facts ON kind = 'genes' AND entity_id = gene_id""",
    "gene_counts": """
        SELECT query_key, count(g) AS gold, count(f) AS found, count(g + f) AS tp,
               count(f) - count(g + f) AS fp, count(g) - count(g + f) AS fn
        FROM (SELECT *, 1 AS g FROM gene_gold) FULL JOIN (SELECT *, 1 AS f FROM gene_found) USING (query_key, doc_id)
        GROUP BY query_key""",
}
for _name in ("build_wide_publications", "build_wide_counts"):
    _JOB_VIEWS[_name] = _JOB_VIEWS["build_wide"]


def _with_views(name: str, body: str) -> str:
    """The body with the views it needs, dependencies first."""
    views = {**VIEWS, **_JOB_VIEWS.get(name, {})}
    ordered: dict[str, str] = {}

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in views and word not in ordered and views[word] is not text:
                if re.search(rf"\b(FROM|JOIN)\s+{word}\b", text):
                    need(views[word])
                    ordered[word] = views[word]

    need(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in ordered.items()) + "\n" + body


_BODIES["publication_table_colocated"] = _BODIES["publication_table"]
_BODIES["compare_services_overlap"] = _BODIES["overlap"]
_BODIES["compare_services_years"] = _BODIES["year_histogram"]
ORACLE = {name: _with_views(name, body) for name, body in _BODIES.items()}
