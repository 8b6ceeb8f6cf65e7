"""Fixed values. They decide results, so they are kept word for word and in one place."""

# Names.
ENVIRONMENTS = ["des", "pre", "pro"]
DOMAINS = [
    "admin", "agr", "cct", "clt", "eco", "edu", "ell", "fph", "ind", "inf", "jud", "mam",
    "mob", "slt", "sem", "sso", "sci", "societat", "tec", "ter", "trb", "nco", "alt",
]
MODEL_SUFFIX = "model"
PATH_SCHEME = "dbfs:"
CORE_FOLDER = "core_files"
TEMPORARY_FOLDER = "user_files/temporary_files"
SUPPORTED_EXTENSIONS = [".pdf", ".md", ".txt", ".docx"]

# Document states.
READY = "READY"
UPDATING = "UPDATING"
UPDATED = "UPDATED"
PROCESSED_STATES = [UPDATING, UPDATED, READY]

# Sizes.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
BATCH_BYTES = 10000
TOP_K = 5
EMBEDDING_DIMENSION = 3072

# Answer and prompt formats.
ANSWER_PATTERN = r"(?s)<p>(.*?)</p>"
TAG_PATTERN = r"<[^>]+>"
SOURCES_HEADING = "Documents utilitzats:"
PASSAGE_PREFIX = "Passage: "
PASSAGE_SUFFIX = "\n"
NO_CONTEXT = "no context found."
NO_CONTEXT_ANSWER = (
    "No s'ha trobat informació rellevant a la base de dades vectorial. "
    "Revisa si el document seleccionat existeix."
)
ANSWER_SYSTEM_PROMPT = (
    "You are an assistant for question-answering tasks. Use the following pieces of retrieved "
    "context to answer the question. If you don't know the answer, just say that you don't know. "
    "Use three sentences maximum and keep the answer concise. \n\n CONTEXT: \n {context} \n\n "
    "If the context is [no context found.] respond with [" + NO_CONTEXT_ANSWER + "] \n "
    "Ensure the response is in the same language as the conversation below:"
)
REWRITE_SYSTEM_PROMPT = (
    "Given a chat history and the latest user question which might reference context in the chat "
    "history, formulate a standalone question which can be understood without the chat history. "
    "Do NOT answer the question, just reformulate it if needed and otherwise return it as is."
)

# Names of the tables, with the functional name put in.
TABLE_NAMES = {
    "text": "ftr_{}_txt", "track": "aux_{}_track", "chunks": "ftr_{}_chunks", "index": "ftr_{}_idx",
}
