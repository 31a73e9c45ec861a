"""Fixed values of the domain: word lists, tables and patterns that results depend on."""

# --- fixed values: enumerations ------------------------------------------------
SUBTYPES = ("domain", "tutorial", "parameter", "best_practice", "pitfall", "generic")
SUBTYPE_LABEL = {"domain": "Domain", "tutorial": "Tutorial", "parameter": "Parameter", "best_practice": "Best Practice", "pitfall": "Pitfall", "generic": "Generic"}
ENTRY_TYPES = ("capability", "procedure", "heuristic", "constraint", "generic")
RELATIONS = ("contains", "has_subcategory", "belongs_to", "wikilink")
STORE_RELATION = {"contains": "decomposes_to", "has_subcategory": "decomposes_to", "belongs_to": "wikilink", "wikilink": "wikilink"}
TYPE_BOOST = {"domain": 1.3, "parameter": 1.1, "tutorial": 1.0, "best_practice": 1.0, "pitfall": 1.0, "generic": 0.6}
HUB_TITLES = ("INCAR", "POTCAR", "KPOINTS", "POSCAR", "OUTCAR", "INCAR tag", "Examples")

# --- fixed values: page rules --------------------------------------------------
EXCLUDED_PREFIXES = ("Special_", "Talk_", "User_", "Template_", "MediaWiki_", "File_", "Construction_")
LINK_PREFIXES_DROPPED = ("http", "#", "javascript", "mailto", "../images/", "../resources/")
LINK_PARTS_DROPPED = ("Special:", "Talk:", "File:")
EMPTY_PAGE = "there is currently no text in this page"
EMPTY_CATEGORY = "currently contains no pages or media"
FACT_FREE_STARTS = ("The INCAR file is", "You provide command")

# --- fixed values: classifier --------------------------------------------------
TUTORIAL_TAGS = ("examples", "tutorials", "howto", "installation")
PITFALL_TAGS = ("common pitfalls", "known issues", "troubleshooting")
FILE_TAGS = ("files", "input files", "output files", "pseudopotentials", "potcar tag", "incar")
DOMAIN_TOPICS = (
    "magnetism", "band structure", "density of states", "phonons", "exchange-correlation functionals", "hybrid functionals",
    "van der waals functionals", "dft+u", "dielectric properties", "molecular dynamics", "ionic minimization", "forces",
    "electrostatics", "symmetry", "crystal momentum", "electronic minimization", "electronic ground-state properties",
    "berry phases", "chemical shifts", "machine-learned force fields", "many-body perturbation theory", "bethe-salpeter equations",
    "time-dependent density-functional theory", "linear response", "transition states", "ensembles", "thermostats",
    "electron-phonon interactions", "wannier functions", "constrained-random-phase approximation", "gw", "acfdt", "mp2",
    "low-scaling gw and rpa", "xas", "nmr", "atoms and molecules", "defects", "spin spirals", "spin-orbit coupling",
    "noncollinear magnetism", "metadynamics", "biased molecular dynamics", "blue-moon ensemble", "constrained molecular dynamics",
    "interface pinning", "slow-growth approach", "thermodynamic integration", "advanced molecular-dynamics sampling",
    "ensemble properties", "density mixing", "charge density", "potential", "projector-augmented-wave method", "calculation setup",
    "electronic occupancy", "gpu", "hdf5 support", "development version", "version", "programming", "workshops", "vasp",
)
TUTORIAL_NAMES = ("tutorial", "how to", "howto", "calculation", "calculations", "structure optimization", "molecular dynamics")
PRACTICE_NAMES = ("best practice", "recommended", "convergence", "accuracy")
PITFALL_NAMES = ("be careful", "beware", "do not", "avoid", "common pitfall", "known issue", "troubleshooting")

# --- fixed values: cleaning ----------------------------------------------------
NAV_MARKERS = (
    r"\bRelated tags and (?:articles|sections)\b", r"\bExamples that use this tag\b", r"\bFurther things to try\b",
    r"\bList of tutorials\b", r"\bBack to the main page\b", r"\bRetrieved from\b",
    r"\bThe following \d+ pages? (?:is|are) in this category\b", r"\bPages in category\b",
    r"\bThis category (?:currently )?contains (?:only )?the following", r"\bDownload \w+\.(?:tgz|tar\.gz|zip)\b", r"\bSubcategories\b",
)
LATEX_SYMBOLS = {
    "\\hbar": "ℏ", "\\pi": "π", "\\sigma": "σ", "\\Sigma": "Σ", "\\Gamma": "Γ", "\\Delta": "Δ", "\\Omega": "Ω", "\\infty": "∞",
    "\\times": "×", "\\cdot": "·", "\\ldots": "…", "\\approx": "≈", "\\equiv": "≡", "\\neq": "≠", "\\leq": "≤", "\\geq": "≥",
    "\\to": "→", "\\rightarrow": "→", "\\partial": "∂", "\\nabla": "∇", "\\int": "∫", "\\sum": "Σ", "\\prod": "∏", "\\sqrt": "√",
    "\\langle": "⟨", "\\rangle": "⟩", "\\epsilon": "ε", "\\alpha": "α", "\\beta": "β", "\\gamma": "γ", "\\delta": "δ", "\\lambda": "λ",
    "\\mu": "μ", "\\nu": "ν", "\\tau": "τ", "\\theta": "θ", "\\phi": "φ", "\\omega": "ω", "\\rho": "ρ", "\\eta": "η",
    "\\chi": "χ", "\\xi": "ξ", "\\zeta": "ζ",
}
WARNING_WORDS = (r"\bImportant\b", r"\bWarning\b", r"\bdeprecated\b", r"\bnot recommended\b", r"\bnot supported\b", r"\bstrongly recommend\b")

# --- fixed values: search ------------------------------------------------------
STOP_WORDS = (
    "a", "an", "the", "of", "in", "on", "at", "to", "for", "and", "or", "is", "are", "be", "was", "were", "been",
    "how", "what", "why", "with", "can", "do", "does", "method", "methods", "using", "used", "use", "note", "notes",
    "example", "examples", "result", "results", "value", "values", "case", "cases", "follow", "following", "set", "setting",
    "page", "pages", "see", "also", "may", "default", "will", "must", "should", "need", "needs",
    "one", "two", "first", "well", "much", "part", "type", "per", "due", "via", "way", "many", "often", "without", "within",
    "section", "describe", "described", "shown", "given", "available", "possible", "important", "required",
)
STEM_SUFFIXES = (
    "izational", "isation", "izations", "tational", "ational", "ization", "fulness", "ousness", "iveness", "ability",
    "alities", "alisms", "ements", "ations", "istics", "ement", "ments", "ation", "ities", "fully",
    "ingly", "ously", "istic", "izing", "ising", "ical", "able", "ible", "ness", "ment",
    "ship", "tion", "sion", "ally", "ated", "ized", "ised", "ting", "ring", "ling",
    "ding", "sing", "ives", "isms", "ion", "est", "ity", "ism", "ize",
    "ers", "ies", "ing", "als", "ves", "ed", "es", "ly", "al", "ic", "er", "or", "s",
)
MORPH_VARIANTS = {
    "magnetic": ["magnetism", "magnetization", "magnet", "magnetics"],
    "magnetism": ["magnetic", "magnetization", "magnet"],
    "magnetization": ["magnetic", "magnetism", "magnet"],
    "calculation": ["calculations", "compute", "computation", "computing"],
    "setup": ["set up", "setting up", "configuration", "configure"],
    "optimization": ["optimize", "optimisation", "relaxation", "minimization"],
    "relaxation": ["relax", "relaxations", "optimization", "minimization"],
    "convergence": ["converge", "converging", "converged", "convergency"],
    "functional": ["functionals", "xc", "exchange-correlation", "GGA", "LDA"],
    "bandstructure": ["band structure", "band-structure", "bands", "dispersion"],
    "dos": ["density of states", "density-of-states", "DOS"],
    "phonon": ["phonons", "vibrational", "vibration", "frequencies"],
    "dielectric": ["dielectrics", "permittivity", "optical"],
    "moleculardynamics": ["molecular dynamics", "MD", "ab initio md", "AIMD"],
}
CONCEPTS = {
    "magnetic": ["spin", "noncollinear", "spin-orbit", "collinear", "ferromagnetic", "antiferromagnetic"],
    "magnetism": ["spin", "noncollinear", "spin-orbit", "collinear"],
    "spin": ["magnetic", "magnetism", "spin-orbit", "noncollinear", "spin spiral"],
    "encut": ["energy cutoff", "plane wave", "ENMAX", "ENMIN", "cutoff energy"],
    "isif": ["stress", "cell optimization", "cell relaxation", "volume relaxation", "IBRION", "PSTRESS"],
    "kpoint": ["k-points", "k-point", "k point", "k-point mesh", "brillouin zone", "IBZKPT", "KSPACING"],
    "kpoints": ["k-points", "k point", "k-point mesh", "brillouin zone", "IBZKPT", "KSPACING"],
    "relaxation": ["ISIF", "IBRION", "NSW", "EDIFFG", "POTIM", "optimization"],
    "electronic": ["band", "eigenvalues", "charge density", "potential", "wavefunction"],
    "structure": ["lattice", "cell", "position", "POSCAR", "geometry"],
    "pseudopotential": ["POTCAR", "PAW", "PAW potential", "USPP", "ENMAX", "ENMIN"],
    "vdw": ["van der waals", "dispersion", "IVDW", "DFT-D", "vdW-DF"],
    "hybrid": ["HSE", "PBE0", "HFALPHA", "exact exchange", "screened exchange"],
}
COMPOUNDS = {"k-point": "kpoints", "k-points": "kpoints", "k point": "kpoints", "k mesh": "kpoints", "k-mesh": "kpoints", "spin-orbit": "spin orbit coupling", "spin orbit": "spin orbit coupling", "gw": "gw calculations", "dft-d": "vdw", "dft d": "vdw"}
# --- end of fixed values -------------------------------------------------------
