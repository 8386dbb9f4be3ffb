"""Vocabulary of the evidence engine."""

from __future__ import annotations

from dataclasses import dataclass

# Word lists, patterns and tables that results depend on.

METHODS = {
    "IAA": {"salkowski": "Salkowski Reagent Assay", "colorimetric": "Colorimetric Assay", "tryptophan": "L-Tryptophan Supplemented Assay", "hplc": "HPLC", "uplc": "UPLC", "lc-ms": "LC-MS", "gc-ms": "GC-MS", "tlc": "TLC"},
    "NITROGEN": {"acetylene reduction": "Acetylene Reduction Assay (ARA)", "ara": "Acetylene Reduction Assay (ARA)", "ethylene": "Acetylene Reduction Assay (ARA)", "nitrogenase": "Nitrogenase Assay", "gc": "Gas Chromatography"},
    "PHOSPHATE": {"molybdenum": "Molybdenum Blue Method", "pikovoskaya": "Pikovoskaya (PVK) Agar", "pvk": "Pikovoskaya (PVK) Agar", "nbrip": "NBRIP Medium", "clear zone": "Halo Zone Measurement", "halo": "Halo Zone Measurement", "solubilization index": "Solubilization Index (SI)", "hplc": "HPLC"},
    "SIDEROPHORE": {"chrome azurol": "CAS Assay", "cas": "CAS Assay", "siderophore unit": "CAS Assay (SU)", "orange halo": "CAS Agar Halo", "spectrophotomet": "Spectrophotometry"},
    "ACC_DEAMINASE": {"acc deaminase": "ACC Deaminase Assay", "df medium": "DF Salt Medium", "df-medium": "DF Salt Medium", "acrylonitrile": "ACC Degradation Assay", "ketobutyrate": "α-Ketobutyrate Assay"},
    "BIOFILM": {"crystal violet": "Crystal Violet Staining", "microtiter plate": "Microtiter Plate Assay", "biofilm index": "Biofilm Index", "od595": "OD595 Measurement", "od570": "OD570 Measurement", "confocal": "Confocal Microscopy"},
    "HYDROGEN": {"gas chromatography": "Gas Chromatography", "nitrogenase": "Nitrogenase Activity Assay", "hydrogenase": "Hydrogenase Assay", "methylene blue": "Methylene Blue Reduction", "sodium dithionite": "Dithionite Reduction Assay"},
}
OTHER_METHODS = {"spectrophotomet": "Spectrophotometry", "optical density": "OD Measurement", "od600": "OD600"}

METRIC_PATTERNS = {
    "NITROGEN": [
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:nmol|µmol|umol)\s*(?:C2H4|ethylene|C2H2)?(?:[\w\/\-\s]*)(?:h|hr|min|vial|protein)",
        r"(\d+(?:\.\d+)?)\s*(?:nmol|µmol|umol)\s*(?:C2H4|ethylene)?",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:nmol|µmol)\s*(?:c2h4|ethylene|acetylene)\s*(?:per\s+)?(?:vial|tube|flask|culture)[-1\s]*h",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:µg|mg|ng)\s*n\s*(?:fixed\s+)?(?:\/|per)\s*(?:g|plant|ml)",
    ],
    "IAA": [
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:µg|ug|mg)\s*(?:IAA|auxin)?\s*[\/·\s]?\s*(?:mL|ml|L|l)(?:[-1\s]*)\s*(?:IAA|auxin)?",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*ppm",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:ng|µg|ug)\s*/\s*(?:ml|l)\b",
    ],
    "PHOSPHATE": [
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:µg|ug|mg|g)\s*[\/·\s]?\s*(?:mL|ml|L|l|kg|g)(?:[-1\s]*)?",
        r"(?:SI|PSI|index)\s*(?:=|of|:)\s*(\d+(?:\.\d+)?(?:\s*[-–]\s*\d+(?:\.\d+)?)?)",
        r"(\d+(?:\.\d+)?(?:\s*[-–]\s*\d+(?:\.\d+)?)?)\s*(?:mm|cm)\s*(?:halo|zone|diameter)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:µg|ug|mg)\s+p\s*(?:\/\s*l|l[-1\s]|per\s+l)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*%\s*(?:phosphate\s+|phosphorus\s+)?solubili",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*ppm\b",
    ],
    "SIDEROPHORE": [
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*%\s*(?:SU|units|efficiency|reduction)",
        r"(\d+(?:\.\d+)?(?:\s*[-–]\s*\d+(?:\.\d+)?)?)\s*(?:mm|cm)\s*(?:halo|zone|diameter)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*%\s*(?:cas\s+)?(?:decolori[sz]ation|decolouri[sz]ation)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:su|siderophore\s+units?)\b",
    ],
    "ACC_DEAMINASE": [
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*nmol\s*(?:α-ketobutyrate|ketobutyrate)\s*(?:mg|per\s*mg)(?:[-\w\/\s]*)(?:h|hr)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:nmol|µmol)\s*(?:mg|protein)[-1\s]*h[-1\s]?",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:nmol|µmol)\s*/\s*(?:mg\s*(?:protein\s*)?\/\s*h|mg\s*h)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:nmol|µmol)\s*(?:α-?kb|alpha-?kb|α-?ketobutyrate)\s*",
    ],
    "BIOFILM": [
        r"OD\s*(?:595|570)\s*(?:=|of|:)?\s*(\d+(?:\.\d+)?)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*%\s*(?:biofilm|inhibition|reduction)",
        r"(?:absorbance|od)\s*(?:at\s+)?(?:595|570)\s*(?:nm)?\s*(?:of|=|:)?\s*(\d+(?:\.\d+)?)",
        r"(\d+(?:\.\d+)?)\s*[-–]?\s*fold\s+(?:higher|greater|more)\s+biofilm",
    ],
    "HYDROGEN": [
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:ml|mL)\s*(?:H2|hydrogen)\s*(?:\/|per)\s*(?:h|hr|hour)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*µmol\s*(?:H2|hydrogen)\s*(?:mg|per\s*mg)(?:[\w\/\s]*)(?:h|hr)",
        r"(\d+(?:\.\d+)?(?:\s*[-–±]\s*\d+(?:\.\d+)?)?)\s*(?:mmol|µmol|nmol)\s*(?:h2|hydrogen)\s*(?:\/|per)\s*(?:l|liter|litre|culture|flask)",
    ],
}

INTERFERENCE = {
    "IAA": ["phosphate", "phosphorus", "potassium", "zinc", "nitrogen", "siderophore", "ammonia"],
    "NITROGEN": ["phosphate", "iaa", "auxin", "potassium", "siderophore"],
    "PHOSPHATE": ["nitrogen", "iaa", "auxin", "potassium", "zinc"],
    "SIDEROPHORE": ["phosphate", "iaa", "nitrogen"],
    "ACC_DEAMINASE": ["phosphate", "iaa", "nitrogen", "siderophore"],
    "BIOFILM": ["phosphate", "iaa", "nitrogen"],
    "HYDROGEN": ["phosphate", "iaa", "nitrogen", "siderophore"],
}
KEYWORDS = {
    "IAA": ["iaa", "auxin", "indole"],
    "NITROGEN": ["nitrogen", "fixation", "diazotroph"],
    "PHOSPHATE": ["phosphate", "solubil", "phosphorus"],
    "SIDEROPHORE": ["siderophore", "iron"],
    "ACC_DEAMINASE": ["acc deaminase", "acc", "1-aminocyclopropane"],
    "BIOFILM": ["biofilm"],
    "HYDROGEN": ["hydrogen", "h2 production", "biohydrogen"],
}
NAMES = {"IAA": "IAA / Auxin Production", "NITROGEN": "Nitrogen Fixation", "PHOSPHATE": "Phosphate Solubilization", "SIDEROPHORE": "Siderophore Production", "ACC_DEAMINASE": "ACC Deaminase Activity", "BIOFILM": "Biofilm Formation", "HYDROGEN": "Hydrogen Production"}

STRONG_VERBS = ["produc", "(?:bio)?synthesi", "degrad", "solubili[sz]", "fix", "accumulat", "yield", "secret", "excret", "minerali[sz]", "mobili[sz]", "chelat", "cataly"]
CONFIRMATIONS = ["confirm", "demonstrat", "show", "exhibit", "reveal", "observ", "report", "detect", "isolat", "identif", "characteri[sz]", "measur", "quantif", "determin"]
QUALIFIERS = ["maxim", "highest", "optim", "significan", "substantial", "considerabl", "superior", r"best\b", "greatest", "efficien", r"potent(?:ly)?\b", "remarkabl", "notabl"]
WEAK_CONTEXTS = ["hypothesized", "speculated", "suggests", "future studies", "aim of", "goal of", "previously", "review", "unknown"]
NEGATIONS = [
    r"\bnot\s+(?:able\s+to\s+)?(?:produc|degrad|fix|solubili[sz]|synthesi[sz]|secret)\w*\b",
    r"\b(?:did|does|do|was|were|could|can)\s+not\s+\w+",
    r"\bfail(?:ed|s|ing)?\s+to\b",
    r"\bunable\s+to\b",
    r"\bincapable\s+of\b",
    r"\bno\s+(?:\w+\s+){0,2}(?:activit|production|producer|solubili|fixation|formation|synthesis|secretion|halo|zone)\w*\b",
    r"\bnot\s+detect(?:ed|able)\b",
    r"\bnot\s+observed\b",
    r"\bundetect(?:ed|able)\b",
    r"\bnegligible\b",
    r"\babsence\s+of\b",
    r"\bnegative\s+for\b",
    r"\black(?:ed|s|ing)?\b",
    r"\bnon-?(?:producing|producers?|diazotrophic)\b",
]
CLAUSE_ENDS = r"\b(?:though|but|however|while|whereas|although|yet|whilst)\b|[,;:]"
GENERIC_STRAINS = ["the strain", "this strain", "the isolate", "this isolate", "the bacterium", "this bacterium", "the organism", "this organism"]
MOLECULAR = ["pcr", "sequenc", "blast", "16s", "phylogen", "gene", "primer", "amplif", "cloning", "restriction", "rt-pcr", "qpcr", "genotyp", "rrna", "ribosom", "nucleotide", "dna extract", "southern", "northern blot"]
ABBREVIATIONS = ["sp", "spp", "et", "al", "fig", "vs", "approx", "cf", "no", "vol", "avg", "std", "i.e", "e.g"]
INVALID_SPECIES = ["sp", "spp", "strain", "strains", "isolate", "isolates", "mutant", "group", "bacterium", "cells", "gene", "et", "al", "vs", "etc"]
CLONING_HOSTS = ["Escherichia coli", "E. coli", "Saccharomyces cerevisiae", "S. cerevisiae", "Bacillus subtilis", "B. subtilis"]
PLANT_GENERA = ["Arabidopsis", "Oryza", "Zea", "Triticum", "Solanum", "Nicotiana"]
BAD_GENE_WORDS = ["regulator", "repressor", "inhibitor", "pseudo"]
SECTION_WORDS = ["result", "method", "experimental", "availability", "accession"]
GENOME_WORDS = ["genome", "assembly", "deposited", "accession", "genbank", "refseq", "bioproject", "biosample", "whole genome shotgun", "wgs", "ena", "ddbj"]
ACCESSIONS = [r"\bGC[AF]_\d{9}\.\d+\b", r"\b[A-Z]{4,6}\d{8,10}\b", r"\bPRJ[EDN][A-Z]\d+\b", r"\bSAM[EDN][A-Z]?\d+\b", r"\b[A-Z]{1,2}\d{5,8}\.\d+\b"]
APPROXIMATE = r"^(?:~|≈|ca\.\s*|ca\s+|about\s+|approximately\s+|up\s+to\s+|at\s+least\s+|more\s+than\s+|greater\s+than\s+|less\s+than\s+)"
UNIT_CONTEXT = r"\b(?:halo|zone|diameter|production|activity|content|level|concentration|su|units|efficiency|reduction|biofilm|inhibition|cas|decolori[sz]ation|decolouri[sz]ation|solubili\w*|fixation|iaa|auxin|indole|phosphate|phosphorus|nitrogen|hydrogen|siderophore|ethylene|ketobutyrate|protein)\b.*$"
UNITS = {
    "µg/ml": "µg/mL", "ug/ml": "µg/mL", "µg/l": "µg/L", "ug/l": "µg/L", "mg/l": "mg/L", "mg/ml": "mg/mL", "g/l": "g/L", "ppm": "ppm", "mm": "mm", "cm": "cm",
    "nmol/mg/h": "nmol/mg/h", "µmol/mg/h": "µmol/mg/h", "umol/mg/h": "µmol/mg/h", "nmol": "nmol", "µmol": "µmol", "umol": "µmol", "ml/h": "mL/h", "ml/hr": "mL/h",
    "mg p/l": "mg P/L", "µg p/l": "µg P/L", "ug p/l": "µg P/L", "ng/ml": "ng/mL", "ng/l": "ng/L", "nmol/h": "nmol/h", "µmol/h": "µmol/h", "umol/h": "µmol/h", "mmol/h": "mmol/h",
    "%": "%", "si": "SI", "psi": "SI", "su": "SU", "fold": "fold",
}
GENERA = """
Acetobacter Acinetobacter Actinomyces Agrobacterium Alcaligenes Arthrobacter Azospirillum Azotobacter Bacillus Bacteroides Burkholderia Campylobacter
Citrobacter Clostridium Corynebacterium Enterobacter Enterococcus Erwinia Escherichia Klebsiella Lactobacillus Methylobacterium Micrococcus Mycobacterium
Nitrobacter Nitrosomonas Paenibacillus Pantoea Pseudomonas Rhizobium Rhodococcus Salmonella Serratia Sinorhizobium Sphingomonas Staphylococcus
Stenotrophomonas Streptococcus Streptomyces Thiobacillus Vibrio Xanthomonas Bradyrhizobium Mesorhizobium Gluconacetobacter Herbaspirillum Azospira Frankia
Geobacter Shewanella Ralstonia Cupriavidus Comamonas Variovorax Sphingobium Ideonella Azoarcus Paraburkholderia Phyllobacterium Rahnella Raoultella
Shinella Ochrobactrum Flavobacterium Microbacterium Lysobacter Novosphingobium Nocardia Cellulomonas Brevibacillus Lysinibacillus Priestia Nostoc Anabaena
Neorhizobium Allorhizobium Ensifer Devosia Aminobacter Methyloversatilis Chryseobacterium Janthinobacterium Massilia Collimonas Brevundimonas Acidovorax
Pedobacter Luteimonas Sphingopyxis Leifsonia Curtobacterium Kosakonia Gluconobacter Rhodobacter Rhodospirillum Rhodopseudomonas Halomonas Exiguobacterium
Planococcus Glutamicibacter Paenarthrobacter Luteibacter Cohnella Micromonospora Amycolatopsis Kitasatospora Pseudonocardia Fischerella Calothrix
Tolypothrix Cylindrospermum Scytonema Caballeronia Trinickia
""".split()
STOP_WORDS = """
about after also although among analysis and another are assay based because before being below between both can cells compared conclusion control cultured
cultures data did different does during each effect effects either exhibited experiment experiments figure finally for from further grown growth has have
here higher highest however into isolate isolated isolates isolation its level levels material materials may medium method methods microbial moreover most
much nitrogen none not novel only other over overall phosphate plants present previous produced production recent recently result results roots sample
samples several showed significant significantly since soils some species strain strains studies study such supplementary table that the their then there
these they this those three through thus total treatment treatments under using value values various was were when where which while will with within
without would
""".split()
EVIDENCE_COLUMNS = ["pmid", "pmc_id", "pub_year", "organism", "taxonomy_id", "phenotype", "phenotype_status", "confidence", "performance_value", "performance_unit", "performance_range", "performance_metric", "performance_method", "performance_evidence_sentence", "genome_accession", "genome_source", "evidence_score", "title"]
GENE_COLUMNS = ["Organism Name", "Genome Accession", "Gene Symbol", "Gene Count", "Confidence", "GeneID", "Gene Description", "Genotype Status", "TaxID"]

# End of the fixed values.


@dataclass(frozen=True)
class Phenotype:
    """What is looked for: a query, its category if any, and the vocabulary that follows from them."""

    query: str
    category: str | None

    @property
    def root(self) -> str:
        return self.query.lower().split()[0]

    @property
    def terms(self) -> list[str]:
        return KEYWORDS[self.category] if self.category else [self.root]

    @property
    def methods(self) -> dict[str, str]:
        if self.category:
            return METHODS[self.category]
        return {k: v for m in (*METHODS.values(), OTHER_METHODS) for k, v in m.items()}

    @property
    def patterns(self) -> list[str]:
        return METRIC_PATTERNS[self.category] if self.category else [p for ps in METRIC_PATTERNS.values() for p in ps]

    @property
    def rivals(self) -> list[str]:
        return INTERFERENCE.get(self.category, []) if self.category else []


def phenotype(query: str, category: str | None = None) -> Phenotype:
    """A category that is not known is detected from the query: the first of which a keyword is a substring of it."""
    if category not in KEYWORDS:
        category = next((c for c, words in KEYWORDS.items() if any(w in query.lower() for w in words)), None)
    return Phenotype(query, category)
