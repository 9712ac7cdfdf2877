"""Names, patterns, formats and thresholds that results depend on."""

# Entity kinds, and the short name each one has in column names.
KINDS = {
    "genes": "gene",
    "species": "species",
    "terms_go": "go",
    "terms_do": "do",
    "terms_chebi": "chebi",
}
ONTOLOGIES = ("terms_go", "terms_do", "terms_chebi")

# Text form of an entity list: between entries, and between the fields of an entry.
ENTRY_SEPARATOR = "#!#"
FIELD_SEPARATOR = "@!@"

DOCUMENT_PREFIX = "PMC"

# Attributes of a publication, in the order of the publication table.
PUBLICATION_ATTRIBUTES = ("pmid", "doi", "title", "journal", "year")

# Default thresholds and limits.
SCORE_CUT = 3
TOP_N = 100
SUGGESTIONS_PER_COLUMN = 5
PAGE_SIZE = 25
BATCH_SIZE = 2000
MIN_SUPPORT = 0.0001
MIN_CONFIDENCE = 0.95
FIRST_CHART_YEAR = 2011
FIRST_PUBLICATION_DATE = "1900-01-01"
HUMAN_TAXON = "9606"

# Which lookup columns a suggestion text is matched with (pattern of the upper-cased text).
SUGGESTION_ROUTES = (
    (r"^.*$", ("gene_name",)),
    (r"^(P|PM|PMC|PMC[0-9]+)$", ("doc_id",)),
    (r"^[A-Z].*$", ("species_name", "go_name", "do_name", "chebi_name")),
    (r"^[0-9]+$", ("gene_id", "species_id")),
    (r"^(G|GO|GO:|GO:[0-9]+)$", ("go_id",)),
    (r"^(D|DO|DO:|DOI:|DOID:|DOID:[0-9]+)$", ("do_id",)),
    (r"^(C|CH|CHE:|CHEB:|CHEBI:|CHEBI:[0-9]+)$", ("chebi_id",)),
)
MIN_SUGGESTION_LENGTH = 2

# Address of an entity page: the id is appended.
LINK_OUT = {
    "genes": "http://www.ncbi.nlm.nih.gov/gene/",
    "species": "http://www.ncbi.nlm.nih.gov/Taxonomy/Browser/wwwtax.cgi?mode=Info&id=",
    "terms_go": "http://amigo.geneontology.org/cgi-bin/amigo/term_details?term=",
    "terms_do": "http://www.ebi.ac.uk/ontology-lookup/browse.do?ontName=DOID&termId=DOID%3A",
    "terms_chebi": "http://www.ebi.ac.uk/chebi/searchId.do?chebiId=",
}
DOCUMENT_LINK = "http://www.ncbi.nlm.nih.gov/pmc/articles/"
DOI_LINK = "doi://"

# Readable headings for exported columns.
HEADINGS = {
    "title": "Title",
    "doc_id": "PMC ID",
    "gene_name": "Entrez Gene Name",
    "gene_id": "Entrez Gene ID",
    "gene_score": "Gene Score",
    "species_name": "NCBI Species Name",
    "species_id": "NCBI Species ID",
    "species_score": "Species Score",
    "go_name": "Gene Ontology Term Name",
    "go_id": "Gene Ontology ID",
    "go_score": "Gene Ontology Score",
    "do_name": "Disease Ontology Term Name",
    "do_id": "Disease Ontology ID",
    "do_score": "Disease Ontology Score",
    "chebi_name": "ChEBI Term Name",
    "chebi_id": "ChEBI ID",
    "chebi_score": "ChEBI Score",
}

# Evaluation: header of the table, and how gene and species are written per service.
EVALUATION_COLUMNS = (
    "Gene Symbol", "Species", "Service", "OA Publications", "Linked Publications",
    "True Positives", "False Positives", "False Negatives", "Precisions", "Recall",
    "F1 Score", "True Positive Rate", "False Discovery Rate",
)
LATIN_NAMES = (
    ("humans", "hsapiens", "hgnc_symbol"),
    ("mice", "mmusculus", "mgi_symbol"),
    ("drosophila+melanogaster", "dmelanogaster", "flybasename_gene"),
    ("danio+rerio", "drerio", "entrezgene"),
)
SYMBOL_OVERRIDES = (
    ("Myc", "drosophila+melanogaster", "dm"),
    ("DCC", "drosophila+melanogaster", "fra"),
    ("Myc", "danio+rerio", "myca"),
)
GENE_IDS = (
    ("BRCA2", "humans", "675"),
    ("BRCA2", "mice", "12190"),
    ("BRCA2", "drosophila+melanogaster", "37916"),
    ("BRCA2", "danio+rerio", "566758"),
    ("Myc", "humans", "4609"),
    ("Myc", "mice", "17869"),
    ("Myc", "drosophila+melanogaster", "31310"),
    ("Myc", "danio+rerio", "30686"),
    ("APC", "humans", "324"),
    ("APC", "mice", "11789"),
    ("APC", "drosophila+melanogaster", "44642"),
    ("APC", "danio+rerio", "386762"),
    ("DCC", "humans", "1630"),
    ("DCC", "mice", "13176"),
    ("DCC", "drosophila+melanogaster", "36377"),
    ("DCC", "danio+rerio", "569360"),
)
