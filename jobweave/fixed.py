"""Texts, word lists and patterns that results depend on.

Everything here is compared or printed as it stands, so a changed character
changes results.
"""

# --- Fixed values: prompt texts ----------------------------------------------

CLASSIFICATION_SYSTEM = """You are an expert in the International Standard Classification of Occupations (ISCO). Your goal is:

1. Analyze the job title and job description provided by the user.
2. From the list of occupational categories provided, identify the most appropriate ISCO code (4 digits) based on the job description. If the job description is not clear, use the job title to classify the job.
3. Return the 4-digit code in JSON format as specified by the user. If the job cannot be classified within the given categories, return `null` in the JSON.
"""

CLASSIFICATION_USER = """\
- Job Ad Title:
{title}

- Job Ad Description:
{description}

- Relevant Occupational Categories:
{proposed_categories}

{format_instructions}
"""

TRANSLATION_SYSTEM = """You are an excellent translator from {language} to English. You will be provided with a possibly noisy job offer text in {language} that you have to translate. Your task is:

1. **Extract and translate the job title** from {language} to English. Ensure that the title is accurately translated and meaningful.
2. **Extract and translate the job description** (which includes key responsibilities, tasks, and role details) from {language} to English. Summarize the description if necessary, but ensure that all relevant keywords and key information are included. Usually three or four sentences are enough.
3. **Select relevant keywords**: Identify important keywords that classify the job offer, even if they are not directly mentioned in the text. For example, if the job is for a software developer, include terms like "programming" and "software development." Focus only on keywords related to the role and responsibilities, excluding irrelevant details like location or contract type.
4. **Return the translation in JSON format** as explained by the user.
"""

TRANSLATION_USER = """\
- Translate the following Job Ad Title in english:
{title}

- Translate the following Job Ad Description in english:
{description}

{format_instructions}
"""

EXTRACTION_SYSTEM = """You are a specialist in summarization. You will be provided with a possibly noisy job offer, and your task is to extract the main information. Specifically:

1. **Extract and summarize** the relevant information about the **job title** and **job description**. Focus on key responsibilities, tasks, and role details, as this information will be used to classify the job offer.
2. Ensure the summary captures all key details and important keywords related to the job.
3. **Select relevant keywords**: Identify important keywords that classify the job offer, even if they are not directly mentioned in the text. For example, if the job is for a software developer, include terms like "programming" and "software development." Focus only on keywords related to the role and responsibilities, excluding irrelevant details like location or contract type.
4. **Return the job title, the summarized job description and keywords in a JSON format**, as specified by the user.
"""

EXTRACTION_USER = """\
- Job Ad Title:
{title}

- Job Ad Description:
{description}

{format_instructions}
"""

RETRIEVAL_QUERY = "Instruct: {task_description}\nQuery: {query}"

RETRIEVAL_TASK = (
    "Retrieve the most relevant ISCO documents from the dataset based on the provided input by "
    "matching them with the closest ISCO classification labels."
)

# --- Fixed values: descriptions of the answer fields --------------------------

CLASSIFICATION_FIELDS = {
    "codable": (
        "boolean, required",
        "True if enough information is provided to decide classification code, False otherwise.",
    ),
    "class_code": ("string or null", "ISCO classification code Empty if codable=False."),
    "likelihood": (
        "number or null, required",
        "Likelihood of this class_code with value between 0 and 1.",
    ),
}

TRANSLATION_FIELDS = {
    "job_desc_extracted": (
        "boolean, required",
        "True if the job description has been extracted.",
    ),
    "title": ("string or null, required", "The job title in english."),
    "description": ("string or null, required", "The job description in english."),
    "keywords": (
        "array of strings or null, required",
        "A list of important terms focused on the job-specific skills, responsibilities, fields, "
        "or qualifications, and should not include geographic locations or overly broad "
        "categories. Limit to a maximum of 5 terms.",
    ),
}

# --- Fixed values: headings in the notes of an occupation, in priority order ---

TASK_HEADINGS = [
    "Tasks include -",
    "In such cases tasks would include -",
    "In such cases tasks performed would include -",
    "In such instances tasks would include -",
]

EXAMPLE_HEADINGS = [
    "Examples of the occupations classified here:",
    "Example of the occupations classified here:",
]

# --- Fixed values: cleaning ----------------------------------------------------
# The patterns are Java patterns. [\s\x1c-\x1f] under (?U) matches what str.strip takes off; that class is
# one test per character, where the same characters listed one by one are more than twenty.

WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
TAG_PATTERN = r"<[^<]+?>"
URL_PATTERN = r"(?U)https?://(?:www\.)?[^\s\x1c-\x1f/$.?#][^\n][^\s\x1c-\x1f]*"
STAR_PATTERN = r"(?U)\*[\s\x1c-\x1f*]*"
SPACES_PATTERN = r"(?U)[\s\x1c-\x1f]{2,}"
NO_BREAK_SPACE = "\u00a0"
JAVASCRIPT_NOTICE = "You need to enable JavaScript to run this app"
CAPTCHA_NOTICE = "reCAPTCHA check page"

# --- Fixed values: texts that a CSV reader takes for a missing value ------------

NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Fixed values: languages (name, two-letter code, three-letter code and script) ---

UNDEFINED = "un"

LANGUAGES = [
    ("English", "en", "eng_Latn"),
    ("German", "de", "deu_Latn"),
    ("Bulgarian", "bg", "bul_Cyrl"),
    ("Croatian", "hr", "hrv_Latn"),
    ("Danish", "da", "dan_Latn"),
    ("Spanish", "es", "spa_Latn"),
    ("Estonian", "et", "est_Latn"),
    ("Finnish", "fi", "fin_Latn"),
    ("French", "fr", "fra_Latn"),
    ("Greek", "el", "ell_Grek"),
    ("Hungarian", "hu", "hun_Latn"),
    ("Irish", "ga", "gle_Latn"),
    ("Italian", "it", "ita_Latn"),
    ("Latvian", "lv", "lvs_Latn"),
    ("Lithuanian", "lt", "lit_Latn"),
    ("Maltese", "mt", "mlt_Latn"),
    ("Dutch", "nl", "nld_Latn"),
    ("Polish", "pl", "pol_Latn"),
    ("Portuguese", "pt", "por_Latn"),
    ("Romanian", "ro", "ron_Latn"),
    ("Slovak", "sk", "slk_Latn"),
    ("Slovenian", "sl", "slv_Latn"),
    ("Swedish", "sv", "swe_Latn"),
    ("Czech", "cs", "ces_Latn"),
    ("Undefined", "un", "und_Latn"),
]

# --- Fixed values: words accepted as booleans in an answer (any case) ------------

TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]

# Where long notes are cut, the coarsest place first: fixed values.
CHUNK_SEPARATORS = ("\n\n", "\n", ".", " ", "")
