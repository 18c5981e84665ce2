"""Fixed schemas of the tables that pass between operators."""

SENTENCE = (
    "sentence_id string, pos bigint, tokens array<string>, text string, "
    "source_file string, source_column string"
)
CLEAN_SENTENCE = "tokens array<string>"
CHUNK = (
    "chunk_id string, global_chunk_index bigint, chunk_index bigint, source_file string, "
    "source_path string, text string, n_characters bigint"
)
DOCUMENT = "source_path string, source_file string, text string"
WORD_VECTOR = "word string, idx bigint, count bigint, vector array<float>"
