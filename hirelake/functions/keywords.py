"""Skill dictionary and title labels.

FIXED VALUES: the keyword lists and the title labels below must equal the
reference pipeline's lists for the tagger and the title dimension to give the
same results.  They are stated as plain text in their natural order.  Four
keywords sit in two categories (sas, mongodb, firebase, ruby); matching is
case-insensitive, so ``openCV`` matches ``opencv``.
"""

from __future__ import annotations

# --- fixed values (keyword categories, in reference order) -----------------
KEYWORDS_PROGRAMMING = [
    "sql", "python", "r", "c", "c#", "javascript", "java", "scala", "sas", "matlab",
    "c++", "perl", "go", "typescript", "bash", "html", "css", "php", "powershell", "rust",
    "kotlin", "ruby", "dart", "assembly", "swift", "vba", "lua", "groovy", "delphi", "objective-c",
    "haskell", "elixir", "julia", "clojure", "solidity", "lisp", "f#", "fortran", "erlang", "apl",
    "cobol", "ocaml", "crystal", "golang", "nosql", "mongodb", "t-sql", "no-sql",
    "pascal", "mongo", "sass", "vb.net", "shell", "visual basic",
]

KEYWORDS_DATABASES = [
    "mysql", "sql server", "postgresql", "sqlite", "mongodb", "redis", "mariadb",
    "elasticsearch", "firebase", "dynamodb", "firestore", "cassandra", "neo4j", "db2",
    "couchbase", "couchdb",
]

KEYWORDS_CLOUD = [
    "aws", "azure", "gcp", "firebase", "heroku", "digitalocean", "vmware", "managedhosting",
    "linode", "ovh", "oracle", "openstack", "watson", "colocation",
    "snowflake", "redshift", "bigquery", "aurora", "databricks", "ibm cloud",
]

KEYWORDS_LIBRARIES = [
    "scikit-learn", "jupyter", "theano", "openCV", "pyspark", "nltk", "mlpack", "chainer", "fann", "shogun",
    "dlib", "mxnet", "keras", ".net", "numpy", "pandas", "matplotlib", "spring", "tensorflow", "flutter",
    "react", "kafka", "electron", "pytorch", "qt", "ionic", "xamarin", "spark", "cordova", "hadoop", "gtx",
    "capacitor", "tidyverse", "unoplatform", "dplyr", "tidyr", "ggplot2", "plotly", "rshiny", "mlr",
    "airflow", "seaborn", "gdpr", "graphql", "selenium", "hugging face", "uno platform",
]

KEYWORDS_WEBFRAMEWORKS = [
    "node.js", "vue", "vue.js", "ember.js", "node", "jquery", "asp.net", "react.js", "express",
    "angular", "asp.netcore", "django", "flask", "next.js", "laravel", "angular.js", "fastapi", "ruby",
    "svelte", "blazor", "nuxt.js", "symfony", "gatsby", "drupal", "phoenix", "fastify", "deno",
    "asp.net core", "ruby on rails", "play framework",
]

KEYWORDS_OS = [
    "unix", "linux", "windows", "macos", "wsl", "ubuntu", "centos", "debian", "redhat",
    "suse", "fedora", "kali", "arch",
]

KEYWORDS_ANALYST_TOOLS = [
    "excel", "tableau", "word", "powerpoint", "looker", "power bi", "outlook", "sas", "sharepoint", "visio",
    "spreadsheet", "alteryx", "ssis", "spss", "ssrs", "microstrategy", "cognos", "dax",
    "esquisse", "sap", "splunk", "qlik", "nuix", "datarobot", "ms access", "sheets",
]

KEYWORDS_OTHER = [
    "npm", "docker", "yarn", "homebrew", "kubernetes", "terraform", "unity", "ansible", "unreal", "puppet",
    "chef", "pulumi", "flow", "git", "svn", "gitlab", "github", "jenkins", "bitbucket", "terminal", "atlassian",
    "codecommit",
]

KEYWORDS_ASYNC = [
    "jira", "confluence", "trello", "notion", "asana", "clickup", "planner", "monday.com", "airtable", "smartsheet",
    "wrike", "workfront", "dingtalk", "swit", "workzone", "projectplace", "cerri", "wimi", "leankor", "microsoft lists",
]

KEYWORDS_SYNC = [
    "slack", "microsoft teams", "twilio", "zoom", "webex", "mattermost", "rocketchat", "ringcentral",
    "symphony", "wire", "wickr", "unify", "coolfire", "google chat",
]

# --- fixed values (zero-shot candidate labels for job titles) ---------------
TITLE_LABELS = [
    "Data Engineer", "Data Scientist", "Data Analyst", "Software Engineer", "Business Analyst",
    "Machine Learning Engineer", "Senior Data Engineer", "Senior Data Scientist", "Senior Data Analyst",
    "Cloud Engineer",
]
# ---------------------------------------------------------------------------

# Category column name -> keyword list, in output column order.
SKILL_CATEGORIES: dict[str, list[str]] = {
    "keywords_programming": KEYWORDS_PROGRAMMING,
    "keywords_databases": KEYWORDS_DATABASES,
    "keywords_cloud": KEYWORDS_CLOUD,
    "keywords_libraries": KEYWORDS_LIBRARIES,
    "keywords_webframeworks": KEYWORDS_WEBFRAMEWORKS,
    "keywords_os": KEYWORDS_OS,
    "keywords_analyst_tools": KEYWORDS_ANALYST_TOOLS,
    "keywords_other": KEYWORDS_OTHER,
    "keywords_async": KEYWORDS_ASYNC,
    "keywords_sync": KEYWORDS_SYNC,
}

ALL_COLUMN = "keywords_all"

# The category listing (keywords mart) covers keywords_all and nine
# categories; the sync category is not listed.
LISTED_CATEGORIES = [ALL_COLUMN] + [c for c in SKILL_CATEGORIES if c != "keywords_sync"]


def dictionary_rows(categories: dict[str, list[str]] | None = None) -> list[tuple[str, str]]:
    """(category, keyword) pairs, keywords lower-cased, in list order."""
    categories = SKILL_CATEGORIES if categories is None else categories
    return [(cat, kw.lower()) for cat, kws in categories.items() for kw in kws]
