"""SQL twins of the registered queries, for DuckDB on the same tables."""

from pairloom.functions.text import WHITESPACE
from pairloom.operators.judging import JUDGE_TEMPLATE
from pairloom.operators.scoring import CHOICE_SYSTEM_PROMPT, DEFAULT_SYSTEM_PROMPT
from pairloom.operators.training import SYSTEM_PROMPT
from pairloom.plans.enrich import ENRICH_TEMPLATE, TRACE_TEMPLATE

# --- expressions -----------------------------------------------------------

_WS_CLASS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
NUMBER = r"[-+]?\p{Nd}*\.?\p{Nd}+"
LISTED = r"[-+]?\p{Nd}{1,3}(?:,\p{Nd}{3})*(?:\.\p{Nd}+)?|\p{Nd}+(?:\.\p{Nd}+)?"


def lit(text):
    return "'" + text.replace("'", "''") + "'"


def strip(e):
    return f"trim({e}, {lit(WHITESPACE)})"


def clean_number(e):
    t = rf"regexp_replace(replace(nullif({e}, ''), ',', ''), '\.+$', '')"
    return f"coalesce(nullif(regexp_extract({t}, {lit(NUMBER)}), ''), {strip(t)})"


def predicted(e):
    boxes = rf"regexp_extract_all({e}, '\\boxed\{{([^}}]*)\}}', 1)"
    anchor = (
        rf"regexp_extract({e}, '(?:Final [Aa]nswer|The answer is|yields)"
        rf"[:{_WS_CLASS}]*([0-9.,-]+)', 1)"
    )
    numbers = f"regexp_extract_all({e}, {lit(LISTED)})"
    return (
        f"CASE WHEN len({boxes}) > 0 THEN {clean_number(boxes + '[-1]')} "
        f"ELSE coalesce({clean_number(anchor)}, {clean_number(numbers + '[-1]')}) END"
    )


def letter(e):
    boxed = rf"regexp_extract_all({e}, '(?i)\\boxed\{{([A-D])\}}', 1)[-1]"
    lone = (
        rf"nullif(regexp_extract({e}, "
        r"'(?s)^(?:.*[^\p{L}\p{N}_])?([A-Da-d])(?:[^\p{L}\p{N}_].*)?$', 1), '')"
    )
    return f"upper(coalesce({boxed}, {lone}))"


def reference(e):
    tail = strip(f"split_part({e}, '#### ', 2)")
    return (
        f"CASE WHEN contains({e}, '#### ') "
        f"THEN coalesce(nullif({clean_number(tail)}, ''), {tail}) END"
    )


def trace(e):
    return strip(f"regexp_extract({e}, '(?s)<think>(.*?)</think>', 1)")


def unclosed(e):
    return f"(contains({e}, '<think>') AND NOT contains({e}, '</think>'))"


def answer_part(e):
    return f"CASE WHEN {unclosed(e)} THEN '' ELSE {strip(f'''split_part({e}, '</think>', -1)''')} END"


def tokens(e):
    return rf"coalesce(len(regexp_extract_all({e}, '[^\t\n\x0b\f\r ]+')), 0)::BIGINT"


def html_length(e):
    return f"length({strip(f'''regexp_replace(coalesce({e}, ''), '<[^>]+>', '', 'g')''')})::BIGINT"


def clean_html(e):
    """Only for texts whose entities are the five below."""
    for entity, char in (
        ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&amp;", "&"),
    ):
        e = f"replace({e}, '{entity}', {lit(char)})"
    code = f"<pre><code>[{_WS_CLASS}]*(.*?)[{_WS_CLASS}]*</code></pre>"
    e = f"regexp_replace(coalesce({e}, ''), '{code}', E'\\n[CODE]\\n\\\\1\\n[/CODE]\\n', 'gs')"
    e = f"regexp_replace({e}, '<[^>]+>', '', 'g')"
    e = rf"regexp_replace({e}, '\n{{3,}}', E'\n\n', 'g')"
    return strip(e)


def digest(key, seed, purpose):
    return f"md5('{purpose}:{seed}:' || {key}::VARCHAR)"


def draw(key, seed, purpose):
    return f"(('0x' || substr({digest(key, seed, purpose)}, 1, 8))::BIGINT / 4294967296.0)"


def fill(template, **slots):
    out = lit(template)
    for name, e in slots.items():
        out = out.replace("{%s}" % name, f"' || {e} || '")
    return out


def turn(role, content):
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


# --- derived tables --------------------------------------------------------

_BODY = """'<p>' || text || '</p>' || chr(10)
        || CASE WHEN doc_id % 7 = 0 THEN '<img src="x.png">' ELSE '' END"""


def _posts(body):
    return f"""SELECT doc_id AS Id,
        CASE WHEN doc_id % 4 = 0 THEN '1' ELSE '2' END AS PostTypeId,
        CASE WHEN doc_id % 4 <> 0 THEN doc_id - doc_id % 4 END AS ParentId,
        'On ' || source || ' ' || doc_id::VARCHAR AS Title,
        {body} AS Body,
        '<' || lang || '><' || source || '>' AS Tags,
        n_chars % 10 AS Score FROM documents"""


_RESULT = f"""SELECT o.benchmark, o.model, o.item_pos, i.question,
        i.reference AS reference_answer,
        %s AS predicted_answer,
        {tokens(trace('o.raw_output'))} AS thinking_tokens,
        {tokens(answer_part('o.raw_output'))} AS answer_tokens,
        o.time_seconds, o.raw_output
        FROM (SELECT '%s' AS benchmark, * FROM outputs) o
        JOIN %s i ON o.item_pos = i.item_pos"""

CTES = {
    "posts": _posts(_BODY),
    "posts_nulls": _posts(f"CASE WHEN doc_id % 9 <> 0 THEN {_BODY} END"),
    "votes": """SELECT l_partkey AS PostId, CASE WHEN l_quantity > 45 THEN '1'
        WHEN l_returnflag = 'A' THEN '3' ELSE '2' END AS VoteTypeId FROM lineitem""",
    "counts": """SELECT PostId, count(*) FILTER (VoteTypeId = '2') AS Upvotes,
        count(*) FILTER (VoteTypeId = '3') AS Downvotes
        FROM votes WHERE VoteTypeId IN ('2', '3') GROUP BY PostId""",
    "scored": """SELECT p.*, coalesce(Upvotes, 0) AS Upvotes, coalesce(Downvotes, 0) AS Downvotes
        FROM posts p LEFT JOIN counts c ON p.Id = c.PostId""",
    "scored_nulls": """SELECT p.*, coalesce(Upvotes, 0) AS Upvotes, coalesce(Downvotes, 0) AS Downvotes
        FROM posts_nulls p LEFT JOIN counts c ON p.Id = c.PostId""",
    "good": """SELECT * FROM scored WHERE PostTypeId = '1'
        AND Upvotes >= 5 AND Downvotes <= 0.5 * Upvotes""",
    "top": """SELECT ParentId, Id, Body, Score, Upvotes, Downvotes FROM scored
        WHERE PostTypeId = '2'
        QUALIFY row_number() OVER (PARTITION BY ParentId ORDER BY Upvotes DESC, Id) = 1""",
    "comments": r"""SELECT user_id * 4 AS PostId,
        CASE WHEN event_type <> 'error' THEN regexp_extract(props, '(\d+)', 1)::BIGINT END AS Score,
        props AS Text, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS CreationDate FROM events""",
    "lines": """SELECT PostId, n, '[comment_' || n::VARCHAR || '] (score='
        || coalesce(Score::VARCHAR, 'None') || '): ' || coalesce(Text, 'None') || chr(10) AS line
        FROM (SELECT *, row_number() OVER (PARTITION BY PostId
        ORDER BY CreationDate, Text, Score NULLS FIRST) AS n FROM comments)""",
    "blocks": """SELECT PostId, string_agg(line, '' ORDER BY n) AS comment_block
        FROM lines GROUP BY PostId""",
    "comment_parts": """SELECT PostId, (n - 1) // 20 AS part, string_agg(line, '' ORDER BY n)
        AS comment_block FROM lines GROUP BY ALL""",
    "pairs": "SELECT ParentId, Id FROM posts WHERE PostTypeId = '2'",
    "processed": "SELECT doc_id AS question_id FROM labels",
    "responses": """SELECT doc_id AS question_id, text AS content,
        CASE WHEN doc_id % 6 = 0 THEN 'length' ELSE 'stop' END AS finish_reason,
        CASE WHEN doc_id % 11 = 0 THEN 'Error code: 429'
        WHEN doc_id % 13 = 0 THEN 'Connection reset' END AS error FROM documents""",
    "status": """SELECT *, CASE WHEN regexp_matches(lower(error), 'quota|insufficient|429') THEN 'quota'
        WHEN error IS NOT NULL THEN 'failed' WHEN finish_reason = 'length' THEN 'truncated'
        ELSE 'ok' END AS status FROM responses""",
    "traced": """SELECT doc_id AS question_id, doc_id + 1 AS answer_id, source AS title,
        text AS question_body, text AS original_answer,
        '**' || source || '** ' || text AS enriched_answer, lang AS tags,
        CASE WHEN doc_id % 8 = 0 THEN '' ELSE 'Consider ' || source || ': ' || text END
        AS thinking_trace_re, doc_id % 10 = 0 AS trace_truncated FROM documents""",
    "split": f"""SELECT *, CASE WHEN row_number() OVER (ORDER BY
        {digest('question_id', 42, 'split')}, question_id) <= 10 THEN 'eval' ELSE 'train' END AS part
        FROM traced""",
    "chats": f"""SELECT *, {turn("'system'", lit(SYSTEM_PROMPT))}
        || {turn("'user'", strip("title || chr(10) || chr(10) || question_body"))}
        || {turn("'assistant'", '''CASE WHEN thinking_trace_re <> '' THEN '<think>'
            || thinking_trace_re || '</think>' || chr(10) || chr(10) ELSE '' END
            || replace(enriched_answer, '**', '')''')} AS text FROM traced""",
    "sized": f"SELECT *, {tokens('text')} AS n_tokens FROM chats",
    "choice_items": """SELECT item_id AS item_pos, text AS question, [substr(text, 1, q),
        substr(text, q + 1, q), substr(text, 2 * q + 1, q), substr(text, 3 * q + 1, q)] AS choices,
        (item_id % 4)::INTEGER AS answer
        FROM (SELECT *, (length(text) + 3) // 4 AS q FROM benchmark)""",
    "mcq": """SELECT 'mmlu_ee' AS benchmark, item_pos, question || chr(10) || chr(10)
        || 'A) ' || choices[1] || chr(10) || 'B) ' || choices[2] || chr(10)
        || 'C) ' || choices[3] || chr(10) || 'D) ' || choices[4] AS question,
        ['A', 'B', 'C', 'D'][answer + 1] AS reference FROM choice_items""",
    "math_refs": """SELECT doc_id AS item_pos, text AS question, CASE WHEN doc_id % 5 = 4 THEN text
        ELSE text || ' #### ' || CASE doc_id % 5 WHEN 0 THEN '1,234.50'
        WHEN 2 THEN doc_id::VARCHAR ELSE n_chars::VARCHAR END END AS answer FROM documents""",
    "math_items": f"""SELECT 'gsm8k' AS benchmark, item_pos, question,
        {reference('answer')} AS reference FROM math_refs""",
    "open_items": """SELECT 'ee_qa' AS benchmark, question_id AS item_pos,
        question_body AS question, enriched_answer AS reference FROM traced""",
    "outputs": """SELECT model, doc_id + shift AS item_pos, CASE (doc_id + turn) % 5
        WHEN 0 THEN '<think>' || text || '</think>' || chr(10) || chr(10) || 'Final Answer: 1,234.50.'
        WHEN 1 THEN '<think>' || text
        WHEN 2 THEN text || ' \\boxed{' || doc_id::VARCHAR || '}'
        WHEN 3 THEN 'The answer is ' || n_chars::VARCHAR || '.' ELSE text END AS raw_output,
        n_chars / 100.0 AS time_seconds
        FROM documents, (VALUES ('base', 0, 0), ('ft', 1, 7)) m(model, turn, shift)""".replace("\\\\", "\\"),
    "math_results": "SELECT *, reference_answer IS NOT DISTINCT FROM predicted_answer AS is_correct FROM ("
    + _RESULT % (
        f"CASE WHEN NOT {unclosed('o.raw_output')} THEN {predicted(answer_part('o.raw_output'))} END",
        "gsm8k", "math_items",
    ) + ")",
    "open_results": "SELECT *, NULL::BOOLEAN AS is_correct FROM ("
    + _RESULT % (
        f"CASE WHEN NOT {unclosed('o.raw_output')} THEN {answer_part('o.raw_output')} END",
        "ee_qa", "open_items",
    ) + ")",
    "letters": """SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' \\boxed{b}'
        WHEN 1 THEN ' so it is C' WHEN 2 THEN ' so it is C, no \\boxed{d}.' ELSE '' END
        AS raw_output FROM documents""".replace("\\\\", "\\"),
    "explanations": """SELECT doc_id AS item_pos, text || CASE doc_id % 5
        WHEN 0 THEN chr(10) || 'Verdict: A'
        WHEN 1 THEN chr(10) || 'Verdict: B' || chr(10) || 'Verdict: A'
        WHEN 2 THEN chr(10) || 'verdict:  tie' WHEN 3 THEN chr(10) || 'Verdict: Both'
        ELSE '' END AS explanation FROM documents""",
    "answered": """SELECT b.item_pos, b.question, b.reference_answer, b.predicted_answer AS base_answer,
        t.predicted_answer AS tuned_answer
        FROM (SELECT * FROM open_results WHERE model = 'base') b
        JOIN (SELECT * FROM open_results WHERE model = 'ft') t USING (item_pos)
        WHERE b.predicted_answer <> '' AND t.predicted_answer <> ''""",
    "placed": f"""SELECT item_pos, question, reference_answer,
        CASE WHEN tuned_first THEN 'Fine-Tuned' ELSE 'Base' END AS model_a,
        CASE WHEN tuned_first THEN 'Base' ELSE 'Fine-Tuned' END AS model_b,
        CASE WHEN tuned_first THEN tuned_answer ELSE base_answer END AS answer_a,
        CASE WHEN tuned_first THEN base_answer ELSE tuned_answer END AS answer_b
        FROM (SELECT *, {draw('item_pos', 42, 'place')} < 0.5 AS tuned_first FROM answered)""",
    "judged": f"""SELECT item_pos, question, model_a, model_b, answer_a, answer_b,
        coalesce(v = 'A' AND model_a = 'Fine-Tuned' OR v = 'B' AND model_b = 'Fine-Tuned', FALSE) AS ft_won,
        coalesce(v = 'A' AND model_a = 'Base' OR v = 'B' AND model_b = 'Base', FALSE) AS base_won,
        coalesce(v = 'TIE', FALSE) AS tie, {strip('explanation')} AS judge_explanation
        FROM (SELECT *, upper(nullif(regexp_extract(explanation,
            '(?i)Verdict:[{_WS_CLASS}]*(A|B|Tie)', 1), '')) AS v
            FROM placed JOIN explanations USING (item_pos))""",
}

_USES = {
    "counts": ["votes"], "scored": ["posts", "counts"], "scored_nulls": ["posts_nulls", "counts"],
    "good": ["scored"], "top": ["scored"], "lines": ["comments"], "blocks": ["lines"], "comment_parts": ["lines"], "pairs": ["posts"],
    "status": ["responses"], "split": ["traced"], "chats": ["traced"], "sized": ["chats"],
    "mcq": ["choice_items"], "math_items": ["math_refs"], "open_items": ["traced"],
    "math_results": ["outputs", "math_items"], "open_results": ["outputs", "open_items"],
    "answered": ["open_results"], "placed": ["answered"], "judged": ["placed", "explanations"],
}


def sql(select, *names):
    """A statement with the named derived tables, and those they use, in front."""
    order = []

    def visit(name):
        for used in _USES.get(name, []):
            visit(used)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + select


# --- one statement per query -----------------------------------------------

_PAIR = "ParentId, Id, Body, Score, Upvotes, Downvotes"
_ENRICHED = "question_id, answer_id, title, question_body, original_answer, enriched_answer, tags"
_OK = "(SELECT * FROM status WHERE status = 'ok')"
_NOT_DONE = "NOT IN (SELECT question_id FROM processed)"
_RESULT_COLUMNS = (
    "benchmark, model, item_pos, question, reference_answer, predicted_answer, is_correct, "
    "thinking_tokens, answer_tokens, time_seconds, raw_output"
)


def _filled(name):
    return f"""(SELECT {name} FROM scored_nulls s WHERE s.ParentId = t.ParentId AND s.PostTypeId = '2'
        AND s.{name} IS NOT NULL ORDER BY Upvotes DESC, Id LIMIT 1) AS {name}"""


_REQUEST = f"""SELECT p.ParentId AS question_id, p.Id AS answer_id,
    {clean_html('q.Title')} AS title, {clean_html('q.Body')} AS question_body,
    {clean_html('a.Body')} AS original_answer, q.Tags AS tags,
    coalesce(b.comment_block, 'None') AS comments
    FROM pairs p LEFT JOIN posts q ON q.Id = p.ParentId LEFT JOIN posts a ON a.Id = p.Id
    LEFT JOIN blocks b ON b.PostId = p.ParentId WHERE p.ParentId {_NOT_DONE}"""

_HEAD, _, _TAIL = ENRICH_TEMPLATE.partition("{comments}")

_REPORT = """SELECT coalesce(b.item_pos, t.item_pos) AS item_pos, b.question,
    b.is_correct AS base_correct, b.thinking_tokens AS base_think_tokens,
    b.answer_tokens AS base_ans_tokens, b.time_seconds AS base_time,
    t.is_correct AS ft_correct, t.thinking_tokens AS ft_think_tokens,
    t.answer_tokens AS ft_ans_tokens, t.time_seconds AS ft_time
    FROM (SELECT * FROM math_results WHERE model = 'base') b
    FULL JOIN (SELECT * FROM math_results WHERE model = 'ft') t ON b.item_pos = t.item_pos"""

_FINAL_TEXT = f"""{turn("'system'", lit(SYSTEM_PROMPT))}
        || {turn("'user'", strip("title || chr(10) || chr(10) || question_body"))}
        || {turn("'assistant'", f'''CASE WHEN thinking_trace_re = '' THEN '' ELSE '<think>'
            || CASE WHEN {draw('question_id', 42, 'drop')} >= 0.3 THEN thinking_trace_re ELSE '' END
            || '</think>' || chr(10) || chr(10) END || replace(enriched_answer, '**', '')''')}"""

TWINS = {
    # curation
    "curate_pairs": sql(
        f"""SELECT t.*, {html_length('q.Body')} AS QuestionLength, {html_length('t.Body')} AS AnswerLength
        FROM top t JOIN good q ON q.Id = t.ParentId
        WHERE t.Upvotes >= 5 AND t.Downvotes <= 0.5 * t.Upvotes
        AND NOT contains(q.Body, '<img') AND NOT contains(t.Body, '<img')
        AND {html_length('q.Body')} >= 300 AND {html_length('t.Body')} >= 300""",
        "top", "good",
    ),
    "posts_by_type": sql(
        """SELECT 'question' AS kind, Id, NULL::BIGINT AS ParentId, Title, Body, Tags, Score
        FROM posts WHERE PostTypeId = '1' UNION ALL
        SELECT 'answer', Id, ParentId, NULL, Body, NULL, Score FROM posts WHERE PostTypeId = '2'""",
        "posts",
    ),
    "votes_up_down": sql(
        "SELECT PostId, VoteTypeId::INTEGER AS VoteTypeId FROM votes WHERE VoteTypeId IN ('2', '3')",
        "votes",
    ),
    "vote_counts": sql("SELECT * FROM counts", "counts"),
    "post_vote_counts": sql(
        "SELECT Id, PostTypeId, Score, Upvotes, Downvotes FROM scored", "scored"
    ),
    "vote_quality": sql(
        "SELECT Id, Upvotes, Downvotes FROM scored WHERE Upvotes >= 5 AND Downvotes <= 0.3 * Upvotes",
        "scored",
    ),
    "no_images": sql("SELECT Id, Body FROM posts WHERE NOT contains(Body, '<img')", "posts"),
    "html_text_length": sql(f"SELECT Id, {html_length('Body')} AS TextLength FROM posts", "posts"),
    "min_text_length": sql(
        f"""SELECT * FROM (SELECT a.ParentId, a.Id, {html_length('q.Body')} AS QuestionLength,
        {html_length('a.Body')} AS AnswerLength
        FROM posts a JOIN posts q ON q.Id = a.ParentId AND q.PostTypeId = '1')
        WHERE QuestionLength >= 300 AND AnswerLength >= 300""",
        "posts",
    ),
    "drop_image_pairs": sql(
        """SELECT a.ParentId, a.Id FROM posts a JOIN posts q ON q.Id = a.ParentId
        WHERE NOT contains(a.Body, '<img') AND NOT contains(q.Body, '<img')""",
        "posts",
    ),
    "answers_of_good_questions": sql(
        "SELECT Id, ParentId, Score FROM posts WHERE PostTypeId = '2' AND ParentId IN (SELECT Id FROM good)",
        "good",
    ),
    "top_answer": sql(f"SELECT {_PAIR} FROM top", "top"),
    "top_answer_filled": sql(
        f"""SELECT ParentId, Id, {_filled('Body')}, {_filled('Score')}, Upvotes, Downvotes
        FROM (SELECT ParentId, Id, Upvotes, Downvotes FROM scored_nulls WHERE PostTypeId = '2'
        QUALIFY row_number() OVER (PARTITION BY ParentId ORDER BY Upvotes DESC, Id) = 1) t""",
        "scored_nulls",
    ),
    "duplicate_ids": sql(
        """SELECT ParentId, count(*) AS n FROM posts WHERE PostTypeId = '2' GROUP BY ParentId
        HAVING count(*) > 1""",
        "posts",
    ),
    # requests
    "target_posts": sql(
        """SELECT 'question' AS kind, Id, count(*) AS n FROM posts WHERE PostTypeId = '1'
        AND Id IN (SELECT ParentId FROM top) GROUP BY Id
        UNION ALL SELECT 'answer', Id, count(*) FROM posts WHERE PostTypeId = '2'
        AND Id IN (SELECT Id FROM top) GROUP BY Id
        UNION ALL SELECT 'comment', PostId, count(*) FROM comments
        WHERE PostId IN (SELECT ParentId FROM top) GROUP BY PostId""",
        "top", "comments",
    ),
    "pair_texts": sql(
        """SELECT p.ParentId, p.Id, q.Title, q.Body AS QuestionBody, q.Tags, a.Body AS AnswerBody
        FROM pairs p LEFT JOIN posts q ON q.Id = p.ParentId AND q.PostTypeId = '1'
        LEFT JOIN posts a ON a.Id = p.Id AND a.PostTypeId = '2'""",
        "pairs",
    ),
    "resume_pending": sql(f"SELECT * FROM pairs WHERE ParentId {_NOT_DONE}", "pairs", "processed"),
    "pending_capped": sql(
        f"SELECT * FROM pairs WHERE ParentId {_NOT_DONE} ORDER BY Id LIMIT 50", "pairs", "processed"
    ),
    "comment_block": sql("SELECT * FROM blocks", "blocks"),
    "comment_parts": sql("SELECT * FROM comment_parts", "comment_parts"),
    "clean_html": f"SELECT page_id, {clean_html('html')} AS text FROM pages",
    "enrich_requests": sql(
        f"""SELECT question_id, answer_id, title, question_body, original_answer, tags,
        {fill(ENRICH_TEMPLATE, title='title', body='question_body', comments='comments',
              answer='original_answer')} AS prompt FROM ({_REQUEST})""",
        "pairs", "blocks", "processed",
    ),
    "enrich_request_parts": sql(
        f"""SELECT question_id, answer_id, section, 0::BIGINT AS part, text FROM (
            SELECT question_id, answer_id, 0 AS section,
            {fill(_HEAD, title='title', body='question_body')} AS text FROM ({_REQUEST})
            UNION ALL SELECT question_id, answer_id, 2,
            {fill(_TAIL, answer='original_answer')} FROM ({_REQUEST}))
        UNION ALL SELECT p.ParentId, p.Id, 1, coalesce(c.part, 0), coalesce(c.comment_block, 'None')
        FROM pairs p LEFT JOIN comment_parts c ON c.PostId = p.ParentId WHERE p.ParentId {_NOT_DONE}""",
        "pairs", "blocks", "comment_parts", "processed",
    ),
    "trace_requests": sql(
        f"""SELECT {_ENRICHED}, {fill(TRACE_TEMPLATE, question='question_body',
        answer='enriched_answer')} AS prompt FROM traced WHERE question_id {_NOT_DONE}""",
        "traced", "processed",
    ),
    # responses
    "merge_enriched": sql(
        f"""SELECT t.question_id, answer_id, title, question_body, original_answer,
        r.content AS enriched_answer, tags FROM traced t JOIN {_OK} r USING (question_id)""",
        "traced", "status",
    ),
    "merge_traces": sql(
        f"""SELECT {_ENRICHED}, {strip('content')} AS thinking_trace_re,
        finish_reason = 'length' AS trace_truncated
        FROM traced JOIN (SELECT * FROM responses WHERE error IS NULL) USING (question_id)""",
        "traced", "responses",
    ),
    "response_status_counts": sql("SELECT status, count(*) AS n FROM status GROUP BY status", "status"),
    "processed_ids": sql(
        "SELECT DISTINCT question_id FROM status WHERE status IN ('ok', 'truncated')", "status"
    ),
    "accumulated_pairs": sql(
        f"""SELECT {_ENRICHED} FROM traced UNION ALL
        SELECT t.question_id, answer_id, title, question_body, original_answer, r.content, tags
        FROM traced t JOIN {_OK} r USING (question_id)""",
        "traced", "status",
    ),
    "token_audit": sql(
        f"""SELECT count(*) AS total_traces, count(*) FILTER (trace_truncated) AS truncated_count,
        round(avg(t), 2) AS avg_tokens, floor(quantile_cont(t, 0.5))::BIGINT AS median_tokens,
        min(t) AS min_tokens, max(t) AS max_tokens, sum(t)::BIGINT AS total_tokens
        FROM (SELECT *, {tokens('thinking_trace_re')} AS t FROM traced WHERE thinking_trace_re <> '')""",
        "traced",
    ),
    "truncated_ids": sql(
        "SELECT question_id FROM traced WHERE thinking_trace_re <> '' AND trace_truncated", "traced"
    ),
    # splits
    "split_eval": sql("SELECT * EXCLUDE (part) FROM split WHERE part = 'eval'", "split"),
    "split_train": sql("SELECT * EXCLUDE (part) FROM split WHERE part = 'train'", "split"),
    "split_summary": sql(
        """SELECT part AS split, count(*) AS n FROM split GROUP BY part
        UNION ALL SELECT 'total', count(*) FROM split""",
        "split",
    ),
    "split_leaks": sql(
        """SELECT question_id AS key, (question_id % 3 <> 0)::BIGINT AS n_train,
        (question_id % 2 = 0)::BIGINT AS n_eval, 1::BIGINT AS n_all
        FROM traced WHERE (question_id % 3 <> 0) = (question_id % 2 = 0)""",
        "traced",
    ),
    "split_differences": sql(
        """SELECT question_id AS key, 1::BIGINT AS n_left, CASE WHEN question_id % 35 = 0 THEN 0
            WHEN question_id % 39 = 0 THEN 2 ELSE 1 END::BIGINT AS n_right
        FROM traced WHERE question_id % 35 = 0 OR question_id % 39 = 0 OR question_id % 77 = 0""",
        "traced",
    ),
    "split_leak_check": sql(
        """SELECT question_id AS key, 0::BIGINT AS n_train, 0::BIGINT AS n_eval, count(*) AS n_all
        FROM split GROUP BY question_id HAVING count(DISTINCT part) > 1""",
        "split",
    ),
    # training
    "drop_truncated": sql("SELECT * FROM traced WHERE NOT trace_truncated", "traced"),
    "chat_records": sql("SELECT question_id, text FROM chats", "chats"),
    "token_budget": sql(
        "SELECT question_id, n_tokens FROM sized WHERE n_tokens <= 512", "sized"
    ),
    "train_profile": sql(
        """SELECT count(*) AS raw, count(*) FILTER (n_tokens <= 512) AS kept,
        count(*) FILTER (n_tokens <= 512 AND thinking_trace_re <> '') AS with_trace,
        count(*) FILTER (n_tokens <= 512 AND thinking_trace_re = '') AS without_trace,
        count(*) FILTER (n_tokens > 512) AS too_long FROM sized""",
        "sized",
    ),
    "drop_trace": sql(
        f"""SELECT question_id, thinking_trace_re <> '' AND {draw('question_id', 42, 'drop')} < 0.3
        AS trace_dropped FROM traced""",
        "traced",
    ),
    "training_texts": sql(f"SELECT question_id, {_FINAL_TEXT} AS text FROM traced", "traced"),
    "training_sequences": sql(
        f"""SELECT question_id, text, n_tokens, shard, end_token, (end_token - n_tokens) // 512 AS start_block,
        greatest(end_token - 1, end_token - n_tokens) // 512 AS end_block
        FROM (SELECT *, (sum(n_tokens) OVER (PARTITION BY shard ORDER BY question_id))::BIGINT AS end_token
            FROM (SELECT question_id, final AS text, {tokens('final')} AS n_tokens, floor(
                {draw('question_id', 42, 'shard')} * greatest(1, ceil(count(*) OVER () / 500000.0)))::BIGINT AS shard
                FROM (SELECT *, {_FINAL_TEXT} AS final FROM sized WHERE NOT trace_truncated AND n_tokens <= 512)))""",
        "sized",
    ),
    "chat_serialize": f"""SELECT conv_id, string_agg({turn('role', 'text')}, '' ORDER BY turn, role, text)
        AS chat FROM conversations GROUP BY conv_id""",
    "turn_parts": f"""SELECT conv_id, part, string_agg({turn('role', 'text')}, '' ORDER BY n) AS chat
        FROM (SELECT *, (n - 1) // 3 AS part FROM (SELECT *, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations))
        GROUP BY conv_id, part""",
    "supervised_tokens": f"""SELECT conv_id,
        coalesce(sum({tokens('text')}) FILTER (role = 'assistant'), 0)::BIGINT AS supervised,
        coalesce(sum({tokens('text')}) FILTER (role <> 'assistant'), 0)::BIGINT AS masked
        FROM conversations GROUP BY conv_id""",
    "record_supervision": sql(
        f"""SELECT question_id, {tokens('''CASE WHEN thinking_trace_re <> '' THEN '<think>'
            || thinking_trace_re || '</think>' || chr(10) || chr(10) ELSE '' END
            || replace(enriched_answer, '**', '')''')} AS supervised,
        ({tokens(lit(SYSTEM_PROMPT))} + {tokens("title || chr(10) || chr(10) || question_body")})::BIGINT
        AS masked FROM traced""",
        "traced",
    ),
    "pack_sequences": sql(
        f"""SELECT question_id, shard, n_tokens, end_token, (end_token - n_tokens) // 512 AS start_block,
        greatest(end_token - 1, end_token - n_tokens) // 512 AS end_block
        FROM (SELECT question_id, shard, n_tokens, (sum(n_tokens) OVER (PARTITION BY shard
            ORDER BY question_id))::BIGINT AS end_token
            FROM (SELECT *, floor({draw('question_id', 42, 'shard')} * 16)::BIGINT AS shard FROM sized))""",
        "sized",
    ),
    # evaluation
    "mcq_items": sql("SELECT * FROM mcq", "mcq"),
    "eval_items": sql("SELECT item_pos, question FROM choice_items WHERE item_pos < 100", "choice_items"),
    "item_position": """SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS item_pos
        FROM documents""",
    "eval_prompts": sql(
        f"""SELECT benchmark, item_pos, reference, {turn("'system'", f'''CASE benchmark
            WHEN 'mmlu_ee' THEN {lit(CHOICE_SYSTEM_PROMPT)} ELSE {lit(DEFAULT_SYSTEM_PROMPT)} END''')}
        || {turn("'user'", 'question')} || '<|im_start|>assistant' || chr(10) AS prompt
        FROM (SELECT * FROM mcq UNION ALL SELECT * FROM math_items UNION ALL SELECT * FROM open_items)""",
        "mcq", "math_items", "open_items",
    ),
    "predicted_answer": sql(
        f"""SELECT model, item_pos, {trace('raw_output')} AS thinking_trace,
        {answer_part('raw_output')} AS answer_part, CASE WHEN NOT {unclosed('raw_output')}
        THEN {predicted(answer_part('raw_output'))} END AS predicted_answer FROM outputs""",
        "outputs",
    ),
    "mcq_answer": sql(f"SELECT doc_id, {letter('raw_output')} AS answer FROM letters", "letters"),
    "reference_answer": sql("SELECT item_pos, reference FROM math_items", "math_items"),
    "exact_match": sql(
        "SELECT model, item_pos, reference_answer, predicted_answer, is_correct FROM math_results",
        "math_results",
    ),
    "score_outputs": sql(
        f"""SELECT {_RESULT_COLUMNS} FROM math_results
        UNION ALL SELECT {_RESULT_COLUMNS} FROM open_results""",
        "math_results", "open_results",
    ),
    "model_summary": sql(
        """SELECT benchmark, model, round(coalesce(avg(is_correct::INTEGER), 0) * 100, 6) AS accuracy,
        round(avg(thinking_tokens), 6) AS avg_thinking_tokens,
        round(avg(answer_tokens), 6) AS avg_answer_tokens,
        round(avg(time_seconds), 6) AS avg_time_seconds
        FROM (SELECT * FROM math_results UNION ALL BY NAME SELECT * FROM open_results)
        GROUP BY benchmark, model""",
        "math_results", "open_results",
    ),
    "compare_models": sql(_REPORT, "math_results"),
    "model_results": sql("SELECT model, item_pos, predicted_answer, is_correct FROM math_results", "math_results"),
    "mcq_scored": sql(
        f"""SELECT benchmark, 'base' AS model, item_pos, reference AS reference_answer,
        predicted_answer, reference IS NOT DISTINCT FROM predicted_answer AS is_correct,
        {tokens(trace('raw_output'))} AS thinking_tokens, {tokens(answer_part('raw_output'))} AS answer_tokens
        FROM (SELECT *, CASE WHEN NOT {unclosed('raw_output')} THEN {letter(answer_part('raw_output'))} END
            AS predicted_answer FROM letters JOIN mcq ON doc_id = item_pos)""",
        "letters", "mcq",
    ),
    "eval_pending": sql(
        """SELECT 'ft' AS model, benchmark, item_pos, question, reference FROM math_items
        WHERE item_pos NOT IN (SELECT item_pos FROM outputs WHERE model = 'ft')""",
        "math_items", "outputs",
    ),
    # judging
    "judge_pairs": sql(
        f"""SELECT item_pos, question, model_a, model_b, answer_a, answer_b,
        {fill(JUDGE_TEMPLATE, question='question', reference='reference_answer',
              answer_a='answer_a', answer_b='answer_b')} AS prompt FROM placed""",
        "placed",
    ),
    "judge_pending": sql(
        "SELECT item_pos, model_a, model_b FROM placed WHERE item_pos NOT IN (SELECT doc_id FROM labels)",
        "placed",
    ),
    "verdicts": sql("SELECT * FROM judged", "judged"),
    "judge_rates": sql(
        """SELECT total, ft_won_count, base_won_count, tie_count,
        ft_won_count / total * 100 AS ft_won_rate, base_won_count / total * 100 AS base_won_rate,
        tie_count / total * 100 AS tie_rate
        FROM (SELECT count(*) AS total, count(*) FILTER (ft_won) AS ft_won_count,
        count(*) FILTER (base_won) AS base_won_count, count(*) FILTER (tie) AS tie_count FROM judged)""",
        "judged",
    ),
    # files written and read back
    "xml_posts": sql("SELECT * FROM posts", "posts"),
    "xml_votes": sql(
        "SELECT PostId, VoteTypeId::INTEGER AS VoteTypeId FROM votes WHERE VoteTypeId IN ('2', '3')",
        "votes",
    ),
    "xml_comments": sql("SELECT * FROM comments", "comments"),
    "csv_pairs": sql(
        f"""SELECT {_PAIR}, {html_length('q_body')} AS QuestionLength, {html_length('Body')} AS AnswerLength
        FROM (SELECT t.*, q.Body AS q_body FROM top t JOIN posts q ON q.Id = t.ParentId)""",
        "top", "posts",
    ),
    "jsonl_records": sql("SELECT * FROM traced", "traced"),
    "processed_id_file": sql("SELECT question_id FROM processed", "processed"),
    "output_ids": sql("SELECT DISTINCT question_id FROM traced", "traced"),
    "split_files": sql("SELECT part, * EXCLUDE (part) FROM split", "split"),
    "benchmark_files": sql("SELECT question, choices[1] || choices[2] || choices[3] || choices[4] AS joined, answer FROM choice_items", "choice_items"),
    "benchmark_math_files": sql("SELECT question, answer FROM math_refs", "math_refs"),
    "benchmark_open_files": sql("SELECT question_id, question_body, enriched_answer FROM traced", "traced"),
    "result_files": sql(f"SELECT {_RESULT_COLUMNS} FROM math_results", "math_results"),
    "verdict_files": sql("SELECT * FROM judged", "judged"),
    "comparison_file": sql(_REPORT, "math_results"),
    "streamed_trace_requests": sql(
        f"""SELECT {_ENRICHED}, {fill(TRACE_TEMPLATE, question='question_body',
        answer='enriched_answer')} AS prompt FROM traced""",
        "traced",
    ),
}
