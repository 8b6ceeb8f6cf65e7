"""The same results in SQL, over the same tables, for every checked query that SQL can express."""

from pergamon import fixed_values as V
from pergamon.schemas import INDEX
from pergamon.sources.views import VOLUME

# Common table expressions and what each needs.
_VIEWS = {
    "files": ("", f"""
        SELECT doc_id, lang,
          CASE WHEN doc_id % 10 < 2 THEN 'shared_' || CAST(doc_id // 2 AS VARCHAR)
               ELSE 'doc_' || CAST(doc_id AS VARCHAR) END
          || CASE (doc_id // 2) % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.md' WHEN 2 THEN '.PDF'
               WHEN 3 THEN '.docx' ELSE '.py' END AS file_name,
          CASE WHEN doc_id % 2 = 0 THEN '{VOLUME}/core_files/' || source
               ELSE '{VOLUME}/user_files/temporary_files' END AS folder_name,
          CASE WHEN doc_id % 2 = 0 THEN 'core' ELSE 'tmp' END AS document_type,
          text AS extracted_text
        FROM documents"""),
    "gone_files": ("", f"""
        SELECT page_id, 'shared_' || CAST(page_id AS VARCHAR) || '.txt' AS file_name,
          '{VOLUME}/core_files/pages' AS folder_name, 'core' AS document_type,
          html AS extracted_text
        FROM pages"""),
    "track": ("files gone_files", """
        SELECT file_name, folder_name, document_type,
          CASE WHEN quality = 1 AND toxic = 0 THEN 'READY' WHEN quality = 1 THEN 'UPDATED'
               WHEN toxic = 0 THEN 'UPDATING' ELSE 'FAILED' END AS status
        FROM files JOIN labels USING (doc_id)
        UNION ALL
        SELECT file_name, folder_name, document_type, 'READY' FROM gone_files"""),
    "volume": ("files", "SELECT folder_name || '/' || file_name AS path FROM files"),
    "arrivals": ("files", "SELECT * FROM files WHERE lang = 'en'"),
    "texts": ("files gone_files", """
        SELECT doc_id * 2 AS id, file_name, folder_name, document_type, extracted_text FROM files
        UNION ALL
        SELECT page_id * 2 + 1, file_name, folder_name, document_type, extracted_text
        FROM gone_files"""),
    "chunks": ("texts", """
        SELECT id * 4194304 + i AS id, file_name,
          substring(extracted_text, 1 + i * 800, 1000) AS text_chunk, folder_name, document_type,
          CAST(i AS BIGINT) AS chunk_location_in_doc, CAST(n AS BIGINT) AS total_chunks_in_doc,
          CAST(length(substring(extracted_text, 1 + i * 800, 1000)) AS BIGINT)
            AS chunk_length_in_chars
        FROM (SELECT *, greatest(1, CAST(ceil((length(extracted_text) - 200) / 800.0) AS BIGINT))
                AS n FROM texts WHERE length(extracted_text) > 0) t, unnest(range(0, n)) u(i)"""),
    "processed": ("track", """
        SELECT folder_name || '/' || file_name AS path FROM track
        WHERE status IN ('UPDATING', 'UPDATED', 'READY')"""),
    "gone": ("track volume", """
        SELECT folder_name || '/' || file_name AS path FROM track EXCEPT SELECT path FROM volume"""),
    "gone_keys": ("gone", """
        SELECT regexp_replace(path, '/[^/]*$', '') AS folder_name,
          string_split(path, '/')[-1] AS file_name FROM gone"""),
    "paths": ("volume", "SELECT path FROM volume UNION ALL SELECT url FROM pages"),
    "html_texts": ("", """
        SELECT 'page' AS kind, page_id AS key, CAST(0 AS BIGINT) AS turn, html FROM pages
        UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations"""),
    "history": ("", f"""
        SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' ELSE 'ai' END AS speaker,
          CASE WHEN role = 'assistant' AND regexp_matches(text, '{V.ANSWER_PATTERN}')
               THEN regexp_extract(text, '{V.ANSWER_PATTERN}', 1) ELSE text END AS content
        FROM conversations WHERE role IN ('user', 'assistant')"""),
    "numbered": ("chunks", """
        SELECT row_number() OVER (ORDER BY folder_name, file_name, chunk_location_in_doc) AS id,
          folder_name, file_name, chunk_location_in_doc, text_chunk FROM chunks"""),
    "vectors": ("", """
        SELECT vec_id AS id, 'doc_' || CAST(label AS VARCHAR) AS file_name,
          CAST(embedding AS DOUBLE[]) AS v FROM embeddings"""),
    "vector_queries": ("", """
        SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q,
          CASE WHEN label = 0 THEN CAST([] AS VARCHAR[])
               ELSE ['doc_' || CAST(label AS VARCHAR), 'doc_' || CAST((label + 1) % 10 AS VARCHAR)]
          END AS selected
        FROM embeddings"""),
    "requests": ("", """
        SELECT event_id AS query_id, value AS query_execution_time, event_type AS retrieval_method,
          CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS BIGINT)
            AS num_selected_documents,
          CASE WHEN event_type = 'error' THEN '' ELSE 'doc_' || k END AS retrieval_filters,
          CAST(least(CAST(k AS BIGINT), 5) AS BIGINT) AS num_retrieved_documents,
          1 + CAST(k AS BIGINT) % 9 AS batch_size
        FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events) e"""),
    "conversation_questions": ("", """
        SELECT conv_id AS query_id, arg_max(text, turn) AS question,
          count(*) FILTER (WHERE role IN ('user', 'assistant')) > 1 AS needs_rewrite
        FROM conversations GROUP BY conv_id"""),
    "benchmark_questions": ("", """
        SELECT item_id AS query_id, text AS question, FALSE AS needs_rewrite FROM benchmark"""),
}


def _embedding(source, key, text):
    """Unit-length counts of hashed words of `source`, one row per bucket that is not zero."""
    return f"""
        SELECT {key}, b, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {key})) AS FLOAT)
          AS DOUBLE) AS v
        FROM (
          SELECT {key}, CAST('0x' || substring(md5(word), 1, 8) AS BIGINT) % 64 AS b,
            CAST(count(*) AS DOUBLE) AS c
          FROM (SELECT {key}, unnest(string_split_regex({text}, '[^\\p{{L}}\\p{{N}}]+')) AS word
                FROM {source}) w
          WHERE word <> '' GROUP BY ALL) n"""


_VIEWS["chunk_values"] = ("chunks", _embedding("chunks", "id", "text_chunk"))


_VIEWS["followup_questions"] = ("conversation_questions history", """
    SELECT query_id, question, needs_rewrite,
      CASE WHEN needs_rewrite THEN coalesce(search, '') ELSE question END AS search_text
    FROM conversation_questions LEFT JOIN (
      SELECT conv_id AS query_id, string_agg(content, ' ' ORDER BY turn) AS search
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
            FROM history WHERE speaker = 'human') h
      WHERE back <= 2 GROUP BY conv_id) f USING (query_id)""")


def _answers(questions, text="question"):
    """Views that answer the questions of a view: hits in rank order, then the texts."""
    p = questions.split("_")[0]
    _VIEWS[f"{p}_values"] = (questions, _embedding(questions, "query_id", text))
    _VIEWS[f"{p}_pairs"] = (f"{p}_values chunk_values", f"""
        SELECT query_id, id, sum(q.v * c.v) / (any_value(ql) * any_value(cl)) AS score
        FROM (SELECT *, sqrt(sum(v * v) OVER (PARTITION BY query_id)) AS ql FROM {p}_values) q
        JOIN (SELECT *, sqrt(sum(v * v) OVER (PARTITION BY id)) AS cl FROM chunk_values) c
          USING (b) GROUP BY query_id, id""")
    _VIEWS[f"{p}_hits"] = (f"{questions} chunks {p}_pairs", f"""
        SELECT query_id, id, rank, file_name, text_chunk FROM (
          SELECT query_id, id, row_number() OVER (PARTITION BY query_id
              ORDER BY round(coalesce(score, 0), 9) DESC, id) AS rank
          FROM {questions} CROSS JOIN (SELECT id FROM chunks) ids
          LEFT JOIN {p}_pairs USING (query_id, id)) r
        JOIN chunks USING (id) WHERE rank <= 5""")
    _VIEWS[f"{p}_contexts"] = (f"{questions} {p}_hits", f"""
        SELECT query_id, question, needs_rewrite,
          coalesce(context, 'no context found.') AS context, coalesce(sources, '') AS sources,
          coalesce(n_retrieved, 0) AS n_retrieved,
          coalesce(best, '{V.NO_CONTEXT_ANSWER.replace("'", "''")}') AS answer,
          coalesce(items, '') AS items
        FROM {questions} LEFT JOIN (
          SELECT query_id, string_agg('Passage: ' || text_chunk || chr(10), '' ORDER BY rank)
              AS context,
            count(*) AS n_retrieved, arg_min(text_chunk, rank) AS best
          FROM {p}_hits GROUP BY query_id) c USING (query_id)
        LEFT JOIN (
          SELECT query_id, string_agg(file_name, '|' ORDER BY first) AS sources,
            string_agg('<li>' || file_name || '</li>', '' ORDER BY first) AS items
          FROM (SELECT query_id, file_name, min(rank) AS first FROM {p}_hits GROUP BY ALL) f
          GROUP BY query_id) s USING (query_id)""")
    _VIEWS[f"{p}_answers"] = (f"{p}_contexts", f"""
        SELECT *, '<p>' || replace(answer, chr(10), '<br>') || '</p><p>{V.SOURCES_HEADING}</p><ul>'
          || items || '</ul>' AS response FROM {p}_contexts""")


_answers("conversation_questions")
_answers("benchmark_questions")
_answers("followup_questions", "search_text")

_EXTENSION_NAME = "regexp_replace(lower(string_split(path, '/')[-1]), '^\\.+', '')"
_PATHS = {
    "path_base_name": "string_split(path, '/')[-1] AS file_name",
    "path_dir_name": "CASE WHEN instr(path, '/') = 0 THEN '' "
                     "ELSE regexp_replace(path, '/[^/]*$', '') END AS folder_name",
    "path_scheme": "'dbfs:' || path AS with_scheme, replace(path, 'dbfs:', '') AS without_scheme",
    "path_trim": "array_to_string(string_split(path, '/')[6:], '/') AS trimmed",
}
_FILE_MATCH = " AND ".join(f"a.{k} = t.{k}" for k in ("file_name", "folder_name", "document_type"))
_CLEAN = r"regexp_replace(extracted_text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g')"
_NEWLINES = r"regexp_replace({}, '\r\n?', chr(10), 'g')"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_DOCX = _STRIP.format(_NEWLINES.format(_CLEAN))
_FINAL_TRACK = f"""
    SELECT t.* REPLACE (CASE WHEN t.status = 'UPDATING' AND EXISTS
        (SELECT 1 FROM arrivals a WHERE {_FILE_MATCH}) THEN 'UPDATED' ELSE t.status END AS status)
    FROM (SELECT * FROM track UNION ALL
          SELECT file_name, folder_name, document_type, 'UPDATING' FROM files t
          WHERE NOT EXISTS (SELECT 1 FROM track a WHERE {_FILE_MATCH})) t
    WHERE t.folder_name || '/' || t.file_name NOT IN (SELECT path FROM gone)"""
_VIEWS["final_track"] = ("track files arrivals gone", _FINAL_TRACK)

_CANDIDATES = "len(selected) = 0 OR list_contains(selected, file_name)"


def _topk(pairs, score="list_cosine_similarity(q, v)", order="DESC"):
    return f"""
        SELECT query_id, id, rank, round(score, 6) AS score FROM (
          SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id
            ORDER BY round(score, 9) {order}, id) AS rank
          FROM (SELECT query_id, id, {score} AS score FROM {pairs}) s) r
        WHERE rank <= 5"""


_VIEWS["filtered_topk"] = (
    "vectors vector_queries",
    _topk(f"vector_queries JOIN vectors ON {_CANDIDATES}"),
)

# Buckets of 8 tables x 4 planes; the signs of the planes are low bits of MD5 sums.
_VIEWS["planes"] = ("", """
    SELECT t, b, list(CASE WHEN CAST('0x' || substring(md5(t || ':' || b || ':' || d), 1, 2)
        AS BIGINT) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY d) AS plane
    FROM range(8) x(t), range(4) y(b), range(64) z(d) GROUP BY t, b""")
_VIEWS["buckets"] = ("vectors planes", """
    SELECT id, t, sum(CASE WHEN list_dot_product(v, plane) > 0 THEN 1 << b ELSE 0 END) AS bucket
    FROM vectors, planes GROUP BY id, t""")
_VIEWS["ann_pairs"] = ("vectors vector_queries buckets", """
    SELECT DISTINCT a.id AS query_id, c.id FROM buckets a JOIN buckets c USING (t, bucket)""")

# Lists around the vectors whose ids come first by MD5, the five nearest of a vector's own and of a query's.
_LISTS, _PROBES = 16, 5
_VIEWS["centroids"] = ("vectors", f"""
    SELECT c, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) AS list FROM (
      SELECT min(id) AS id, v AS c FROM vectors GROUP BY v ORDER BY md5(CAST(min(id) AS VARCHAR)), 1 LIMIT {_LISTS}) s""")
_VIEWS["near_lists"] = ("vectors centroids", """
    SELECT id, list, row_number() OVER (
      PARTITION BY id ORDER BY list_cosine_similarity(v, c) DESC, list) AS near FROM vectors, centroids""")
_VIEWS["list_pairs"] = ("vectors near_lists", f"""
    SELECT q.id AS query_id, r.id FROM near_lists q JOIN near_lists r ON q.list = r.list
    WHERE q.near <= {_PROBES} AND r.near = 1""")
_IN_LISTS = "list_pairs JOIN vector_queries USING (query_id) JOIN vectors USING (id)"

# Rows of each file in each table.
_LEFT = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, folder_name, file_name, count(*) AS n_rows FROM {view} GROUP BY ALL"
    for name, view in [("text", "texts"), ("track", "track"), ("chunks", "chunks"), ("index", "chunks")])

_ORACLE = {
    "list_files": ("", """
        SELECT doc_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS length FROM documents"""),
    "read_text_files": ("", f"""
        SELECT doc_id, md5(t) AS digest, CAST(length(t) AS BIGINT) AS n_chars
        FROM (SELECT doc_id, {_NEWLINES.format('text || chr(10)')} AS t FROM documents) d"""),
    "extract_docx_text": ("files", f"""
        SELECT folder_name || '/' || file_name AS path, {_DOCX} AS extracted_text,
          CAST(NULL AS VARCHAR) AS error
        FROM files WHERE file_name LIKE '%.docx'"""),
    "extract_text": ("files", f"""
        SELECT folder_name || '/' || file_name AS path,
          CASE WHEN file_name LIKE '%.docx' THEN {_DOCX}
               WHEN file_name LIKE '%.txt' OR file_name LIKE '%.md'
               THEN {_NEWLINES.format('extracted_text')} END AS extracted_text,
          CASE WHEN lower(file_name) LIKE '%.pdf' THEN 'no parser for .pdf' END AS error
        FROM files"""),
    "scan_table": ("", "SELECT * FROM documents"),
    "create_tables": ("texts track chunks", """
        SELECT 'text' AS stage, count(*) AS n FROM texts
        UNION ALL SELECT 'track', count(*) FROM track
        UNION ALL SELECT 'chunks', count(*) FROM chunks UNION ALL SELECT 'index', 0"""),
    "write_overwrite_if_empty": ("texts", "SELECT * FROM texts"),
    "write_append": ("track", "SELECT * FROM track"),
    "assign_ids": ("numbered", """
        SELECT id + 1000 AS id, folder_name, file_name, chunk_location_in_doc FROM numbered"""),
    "describe_schema": ("chunks", " UNION ALL ".join(
        f"SELECT '{f.name}' AS col_name, '{f.dataType.simpleString()}' AS data_type, "
        + (f"count({f.name})" if f.name != "chunk_embedding" else "CAST(NULL AS BIGINT)")
        + " AS n_values" + (" FROM chunks" if f.name != "chunk_embedding" else "")
        for f in INDEX
    )),
    "flatten_manifest": ("volume", """
        SELECT path AS source_path, target_path,
          count(*) OVER (PARTITION BY target_path) > 1 AS collides,
          row_number() OVER (PARTITION BY target_path ORDER BY path DESC) = 1 AS stays
        FROM (SELECT path, 'dbfs:/Volumes/alt_des/brz_rag/rag_data_flat/'
                || string_split(path, '/')[-1] AS target_path FROM volume) v"""),
    "preview_limit": ("chunks", "SELECT id, file_name, text_chunk FROM chunks ORDER BY id LIMIT 5"),
    **{key: ("paths", f"SELECT path, {columns} FROM paths") for key, columns in _PATHS.items()},
    "path_concat": ("files", "SELECT doc_id, folder_name || '/' || file_name AS path FROM files"),
    "path_extension": ("paths", f"""
        SELECT *, extension IN ('.pdf', '.md', '.txt', '.docx') AS supported FROM (
          SELECT path, CASE WHEN instr({_EXTENSION_NAME}, '.') = 0 THEN ''
            ELSE '.' || string_split({_EXTENSION_NAME}, '.')[-1] END AS extension
          FROM paths) e"""),
    "route_by_type": ("files", """
        SELECT doc_id, CASE WHEN document_type = 'core' THEN 'rag_data/core_files'
          ELSE 'rag_data/user_files/temporary_files' END AS folder FROM files"""),
    "name_rules": ("", f"""
        SELECT *, string_split(catalog, '_')[-1] IN ('des', 'pre', 'pro') AS valid_environment,
          string_split(catalog, '_')[1] IN ({', '.join(f"'{d}'" for d in V.DOMAINS)})
            AS valid_domain,
          string_split(catalog, '_')[-1] = environment AS matches_environment,
          string_split(model, '_')[-1] = 'model' AS valid_model
        FROM (SELECT doc_id, ['alt', 'zzz'][doc_id % 2 + 1] || '_' || source || '_'
                || ['des', 'pre', 'xxx'][doc_id % 3 + 1] AS catalog,
                ['des', 'pre', 'pro'][(doc_id // 2) % 3 + 1] AS environment,
                source || '_' || ['model', 'bot'][doc_id % 2 + 1] AS model
              FROM documents) n"""),
    "flatten_struct": ("chunks", """
        SELECT folder_name, file_name, document_type, text_chunk, chunk_length_in_chars,
          chunk_location_in_doc, total_chunks_in_doc FROM chunks"""),
    "answer_from_html": ("html_texts", f"""
        SELECT kind, key, turn, CASE WHEN regexp_matches(html, '{V.ANSWER_PATTERN}')
          THEN regexp_extract(html, '{V.ANSWER_PATTERN}', 1) ELSE html END AS answer
        FROM html_texts"""),
    "has_html_tags": ("html_texts", f"""
        SELECT kind, key, turn, regexp_matches(html, '{V.TAG_PATTERN}') AS has_tags
        FROM html_texts"""),
    "format_answer_html": ("files", f"""
        SELECT doc_id, '<p>' || replace(extracted_text, chr(10), '<br>')
          || '</p><p>{V.SOURCES_HEADING}</p><ul><li>' || file_name || '</li><li>' || folder_name
          || '</li></ul>' AS response FROM files"""),
    "processed_paths": ("processed", "SELECT path FROM processed"),
    "chunks_for_files": ("chunks arrivals", """
        SELECT id, file_name, text_chunk FROM chunks
        WHERE file_name IN (SELECT file_name FROM arrivals)"""),
    "remaining_after_delete": ("chunks arrivals", """
        SELECT id, file_name FROM chunks
        WHERE file_name NOT IN (SELECT file_name FROM arrivals)"""),
    "insert_if_absent": ("files track", f"""
        SELECT file_name, folder_name, document_type, 'UPDATING' AS status FROM files t
        WHERE NOT EXISTS (SELECT 1 FROM track a WHERE {_FILE_MATCH})"""),
    "update_status_in": ("track arrivals", """
        SELECT file_name, folder_name, document_type, CASE WHEN status = 'UPDATING'
          AND file_name IN (SELECT file_name FROM arrivals)
          AND folder_name IN (SELECT folder_name FROM arrivals)
          AND document_type IN (SELECT document_type FROM arrivals)
          THEN 'UPDATED' ELSE status END AS status FROM track"""),
    "update_status_tuple": ("track arrivals", f"""
        SELECT file_name, folder_name, document_type, CASE WHEN status = 'UPDATING'
          AND EXISTS (SELECT 1 FROM arrivals a WHERE {_FILE_MATCH})
          THEN 'UPDATED' ELSE status END AS status FROM track t"""),
    "deleted_chunk_ids": ("chunks gone_keys", """
        SELECT id FROM chunks WHERE file_name IN (SELECT file_name FROM gone_keys)"""),
    "delete_by_file": ("texts gone_keys", """
        SELECT * FROM texts WHERE file_name NOT IN (SELECT file_name FROM gone_keys)"""),
    "delete_by_path": ("texts gone", """
        SELECT * FROM texts WHERE folder_name || '/' || file_name NOT IN (SELECT path FROM gone)
        """),
    "index_upsert": ("chunks arrivals", """
        SELECT id, c.file_name, CASE WHEN c.folder_name LIKE '%/pages' OR a.doc_id IS NOT NULL
          THEN 'tmp' ELSE c.document_type END AS document_type, text_chunk
        FROM chunks c LEFT JOIN arrivals a
          ON a.file_name = c.file_name AND a.folder_name = c.folder_name"""),
    "index_delete": ("chunks gone_keys", """
        SELECT id, file_name FROM chunks
        WHERE file_name NOT IN (SELECT file_name FROM gone_keys)"""),
    "retrieve_columns": ("chunks", """
        SELECT event_id AS query_id, id, value AS score, text_chunk, file_name, folder_name,
          chunk_location_in_doc, total_chunks_in_doc, document_type
        FROM events JOIN chunks ON id = user_id * 2 * 4194304"""),
    "selected_documents_filter": ("vectors vector_queries", f"""
        SELECT query_id, any_value(len(selected)) > 0 AS is_filtered, count(id) AS n_candidates
        FROM vector_queries LEFT JOIN vectors ON {_CANDIDATES} GROUP BY query_id"""),
    "new_files": ("volume processed", "SELECT path FROM volume EXCEPT SELECT path FROM processed"),
    "deleted_files": ("gone", "SELECT path FROM gone"),
    "processed_file_names": ("track", "SELECT DISTINCT file_name FROM track"),
    "work_gate": ("volume processed gone", """
        SELECT 'volume' AS stage, count(*) AS n FROM volume
        UNION ALL SELECT 'processed', count(*) FROM processed
        UNION ALL SELECT 'new', count(*) FROM
          (SELECT path FROM volume EXCEPT SELECT path FROM processed) n
        UNION ALL SELECT 'deleted', count(*) FROM gone"""),
    "latest_version": ("", """
        SELECT source AS name, greatest(1, max(CAST(CAST(doc_id % 12 AS VARCHAR) AS BIGINT)))
          AS latest_version FROM documents GROUP BY source"""),
    "chunk_doc_stats": ("chunks", """
        SELECT folder_name, file_name, count(*) AS n_chunks,
          CAST(sum(chunk_length_in_chars) AS BIGINT) AS total_chars,
          max(chunk_length_in_chars) AS max_chars, min(chunk_length_in_chars) AS min_chars,
          round(avg(chunk_length_in_chars), 6) AS avg_chars,
          list_sort(list(chunk_location_in_doc)) = range(0, max(total_chunks_in_doc))
            AS is_complete
        FROM chunks GROUP BY folder_name, file_name"""),
    "query_log": ("requests", "SELECT * FROM requests"),
    "query_log_summary": ("requests", """
        SELECT retrieval_method, count(*) AS n_queries,
          CAST(sum(num_selected_documents) AS BIGINT) AS num_selected_documents,
          CAST(sum(num_retrieved_documents) AS BIGINT) AS num_retrieved_documents,
          CAST(sum(batch_size) AS BIGINT) AS batch_size,
          round(avg(query_execution_time), 6) AS avg_time,
          min(query_execution_time) AS min_time, max(query_execution_time) AS max_time
        FROM requests GROUP BY retrieval_method"""),
    "query_log_quantiles": ("requests", """
        SELECT retrieval_method, quantile, count(*) AS n, TRUE AS is_close
        FROM requests CROSS JOIN (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) q(quantile)
        WHERE query_execution_time IS NOT NULL GROUP BY ALL"""),
    "vector_topk": ("vectors vector_queries", _topk("vector_queries CROSS JOIN vectors")),
    "vector_topk_l2": ("vectors vector_queries", _topk(
        "vector_queries CROSS JOIN vectors", "pow(list_distance(q, v), 2)", "ASC"
    )),
    "vector_topk_filtered": ("filtered_topk", "SELECT * FROM filtered_topk"),
    "vector_topk_l2_filtered": ("vectors vector_queries", _topk(
        f"vector_queries JOIN vectors ON {_CANDIDATES}", "pow(list_distance(q, v), 2)", "ASC"
    )),
    "vector_topk_lists": ("vectors vector_queries list_pairs", _topk(_IN_LISTS)),
    "vector_topk_lists_filtered": ("vectors vector_queries list_pairs", _topk(f"{_IN_LISTS} WHERE {_CANDIDATES}")),
    "lists_recall": ("vectors", """
        SELECT count(*) AS n_queries, CAST(count(*) * least(5, count(*)) AS BIGINT) AS n_neighbours,
          TRUE AS reached FROM vectors"""),
    "vector_topk_ann": ("vectors vector_queries ann_pairs", _topk(
        "ann_pairs JOIN vector_queries USING (query_id) JOIN vectors USING (id)"
    )),
    "upsert_batches": ("chunks", """
        SELECT id, shard, bytes, CAST((sum(bytes) OVER (PARTITION BY shard ORDER BY id) - 1)
          // 10000 AS BIGINT) AS batch
        FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 10000 AS shard,
                CAST(octet_length(encode(text_chunk)) AS BIGINT) AS bytes FROM chunks) n"""),
    "send_upserts": ("chunks", "SELECT *, TRUE AS within_limit FROM chunks"),
    "send_deletes": ("chunks gone_keys", """
        SELECT id FROM chunks WHERE file_name IN (SELECT file_name FROM gone_keys)"""),
    "chunk_window": ("chunks", "SELECT * FROM chunks"),
    "chunk_recursive_contract": ("texts", r"""
        SELECT id, TRUE AS sizes_hold, TRUE AS is_stripped, TRUE AS is_complete, TRUE AS is_in_text,
          TRUE AS is_covered, TRUE AS overlap_holds FROM texts
        WHERE regexp_matches(extracted_text, '\S')"""),
    "embed_text": ("chunk_values", """
        SELECT id, b AS bucket, round(v, 6) AS value FROM chunk_values"""),
    "embed_once": ("chunks chunk_values", """
        SELECT 'rows' AS counted, count(*) AS n FROM chunks
        UNION ALL SELECT 'stored', count(DISTINCT coalesce(text_chunk, '')) FROM chunks
        UNION ALL SELECT 'filled', count(*) FROM chunk_values
        UNION ALL SELECT 'filled rows', count(DISTINCT id) FROM chunk_values
        UNION ALL SELECT 'first run', count(DISTINCT coalesce(text_chunk, '')) FROM chunks
          WHERE chunk_location_in_doc = 0"""),
    "build_index": ("chunks chunk_values", """
        SELECT id, file_name, folder_name, coalesce(n, 0) AS n_filled FROM chunks
        LEFT JOIN (SELECT id, count(*) AS n FROM chunk_values GROUP BY id) f USING (id)"""),
    "flat_copies_to_drop": ("gone volume", """
        SELECT DISTINCT 'dbfs:/Volumes/alt_des/brz_rag/rag_data_flat/' || string_split(path, '/')[-1]
          AS target_path FROM gone
        WHERE string_split(path, '/')[-1] NOT IN (SELECT string_split(path, '/')[-1] FROM volume)"""),
    "build": ("texts chunks", """
        SELECT t.file_name, t.folder_name, t.document_type, 'READY' AS status,
          count(c.id) AS n_indexed
        FROM texts t LEFT JOIN chunks c
          ON c.folder_name = t.folder_name AND c.file_name = t.file_name GROUP BY ALL"""),
    "last_user_query": ("conversation_questions", """
        SELECT query_id AS conv_id, question FROM conversation_questions"""),
    "format_history": ("history", "SELECT * FROM history"),
    "needs_rewrite": ("conversation_questions", """
        SELECT query_id AS conv_id, needs_rewrite FROM conversation_questions"""),
    "build_context": ("benchmark_contexts", "SELECT query_id, context FROM benchmark_contexts"),
    "dedupe_sources": ("benchmark_contexts", "SELECT query_id, sources FROM benchmark_contexts"),
    "answer_prompt": ("conversation_contexts history", """
        SELECT query_id AS conv_id, CAST(0 AS BIGINT) AS position, 'system' AS speaker,
          '{0}' || context || '{1}' AS content FROM conversation_contexts
        UNION ALL SELECT conv_id, turn + 1, speaker, content FROM history""".format(
            *V.ANSWER_SYSTEM_PROMPT.replace("'", "''").split("{context}"))),
    "rewrite_prompt": ("history conversation_questions", """
        SELECT query_id AS conv_id, CAST(0 AS BIGINT) AS position, 'system' AS speaker,
          '{0}' AS content FROM conversation_questions WHERE needs_rewrite
        UNION ALL SELECT conv_id, turn + 1, speaker, content FROM history
        WHERE conv_id IN (SELECT query_id FROM conversation_questions WHERE needs_rewrite)
        """.format(V.REWRITE_SYSTEM_PROMPT.replace("'", "''"))),
    "rag_batch": ("conversation_answers", """
        SELECT query_id, question, needs_rewrite, context, sources, n_retrieved, answer, response
        FROM conversation_answers"""),
    "rag_batch_history": ("followup_contexts followup_questions history", """
        SELECT * EXCLUDE (items), '<p>' || answer || '</p><p>{2}</p><ul>' || items || '</ul>' AS response
        FROM (
          SELECT query_id, question, needs_rewrite, search_text, context, sources,
            md5(concat_ws(chr(10), 'system:{0}' || context || '{1}', told)) AS answer, items
          FROM followup_contexts JOIN (SELECT query_id, search_text FROM followup_questions) f
            USING (query_id)
          LEFT JOIN (SELECT conv_id AS query_id,
              string_agg(speaker || ':' || content, chr(10) ORDER BY turn) AS told
            FROM history GROUP BY conv_id) t USING (query_id)) a""".format(
        *(s.replace("'", "''") for s in V.ANSWER_SYSTEM_PROMPT.split("{context}")),
        V.SOURCES_HEADING)),
    "evaluate_batch": ("benchmark_answers", """
        SELECT query_id, question, answer, sources, response FROM benchmark_answers"""),
    "check_embedding_size": ("", """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(embedding) IS DISTINCT FROM d)
          AS n_wrong_size, CAST(d AS BIGINT) AS dimension
        FROM embeddings, (SELECT unnest([64, 3072]) AS d) s GROUP BY d"""),
    "check_result_shape": ("filtered_topk vectors vector_queries", f"""
        SELECT query_id, count(rank) AS row_count, any_value(least(5, n)) AS expected_count,
          count(rank) = any_value(least(5, n)) AND count(score) = count(rank) AS is_valid
        FROM (SELECT query_id, count(id) AS n FROM vector_queries
              LEFT JOIN vectors ON {_CANDIDATES} GROUP BY query_id) q
        LEFT JOIN filtered_topk USING (query_id) GROUP BY query_id"""),
    "check_response_json": ("", """
        SELECT conv_id, turn, CAST(CASE WHEN role = 'system' THEN 2 ELSE 1 END AS BIGINT)
            AS n_violations,
          CASE WHEN role = 'system' THEN '$.choices[0].message.content, $.usage'
               ELSE '$.choices[0].message.content is empty' END AS violations
        FROM conversations WHERE role = 'system' OR text = ''"""),
    "check_response_json_events": ("", """
        SELECT event_id, CAST(1 + (k IS NULL)::INT AS BIGINT) AS n_violations,
          CASE WHEN k IS NULL THEN '$.k, $.usage' ELSE '$.usage' END AS violations
        FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events) e"""),
    "stream_index_update": ("files", """
        SELECT file_name, folder_name, document_type, 'UPDATED' AS status FROM files
        WHERE lower(file_name) NOT LIKE '%.pdf'"""),
    "stream_new_files": ("volume processed", """
        SELECT path FROM volume EXCEPT SELECT path FROM processed"""),
    "snapshot_diff": ("track final_track", """
        SELECT file_name, folder_name, document_type, change,
          CASE change WHEN 'insert' THEN new_status WHEN 'update_post' THEN new_status
               ELSE old_status END AS status
        FROM (SELECT coalesce(o.file_name, n.file_name) AS file_name,
                coalesce(o.folder_name, n.folder_name) AS folder_name,
                coalesce(o.document_type, n.document_type) AS document_type,
                o.status AS old_status, n.status AS new_status,
                unnest(CASE WHEN o.file_name IS NULL THEN ['insert']
                            WHEN n.file_name IS NULL THEN ['delete']
                            WHEN o.status IS DISTINCT FROM n.status
                            THEN ['update_pre', 'update_post'] ELSE [] END) AS change
              FROM track o FULL JOIN final_track n ON o.file_name = n.file_name
                AND o.folder_name = n.folder_name AND o.document_type = n.document_type) d"""),
    "purge_deleted": ("track texts chunks gone", " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) FILTER (WHERE gone.path IS NOT NULL)
              AS n_removed, count(*) FILTER (WHERE gone.path IS NULL) AS n_left
            FROM {view} v LEFT JOIN gone ON gone.path = v.folder_name || '/' || v.file_name"""
        for name, view in [
            ("chunks", "chunks"), ("index", "chunks"), ("text", "texts"), ("track", "track")
        ]
    )),
    "purge_all_tables": ("track texts chunks gone", f"""
        SELECT * FROM ({_LEFT}) r WHERE folder_name || '/' || file_name NOT IN (SELECT path FROM gone)"""),
    "purge_and_compact": ("track texts chunks gone", f"""
        SELECT * FROM ({_LEFT}) r WHERE folder_name || '/' || file_name NOT IN (SELECT path FROM gone)"""),
    "deleted_shares": ("chunks gone", """
        SELECT CAST(count(*) AS BIGINT) AS n_deleted FROM chunks
        WHERE folder_name || '/' || file_name IN (SELECT path FROM gone)"""),
    "stream_update_tables": ("files texts chunks", f"""
        SELECT * FROM ({_LEFT.replace('FROM track', 'FROM files')}) r
        WHERE folder_name NOT LIKE '%/pages' AND lower(file_name) NOT LIKE '%.pdf'
          AND (table_name IN ('text', 'track') OR lower(file_name) NOT LIKE '%.py')"""),
    "purge_tables": ("chunks gone", """
        SELECT id, file_name, folder_name FROM chunks
        WHERE folder_name || '/' || file_name NOT IN (SELECT path FROM gone)"""),
}


def _with_views(needs, body):
    ordered = []

    def visit(name):
        if name not in ordered:
            for other in _VIEWS[name][0].split():
                visit(other)
            ordered.append(name)

    for name in needs.split():
        visit(name)
    views = ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in ordered)
    return (f"WITH {views}\n" if views else "") + body


for _form in ("vector_topk", "vector_topk_l2", "vector_topk_filtered", "vector_topk_ann", "vector_topk_lists"):
    _ORACLE[f"{_form}_blocks"] = _ORACLE[_form]
_ORACLE["vector_topk_codes"] = _ORACLE["vector_topk"]
_ORACLE["rag_batch_lists"] = _ORACLE["rag_batch"]


def oracle_sql():
    return {key: _with_views(needs, body) for key, (needs, body) in _ORACLE.items()}
