"""DuckDB SQL that must give the same rows as the registered queries.

Views repeat ``fixtures`` in SQL.  Names and word lists come from the same
constants as the Spark side; everything else is written independently.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..functions import text as tx
from ..operators import prompts, rules
from ..operators.baselines import EMPTY_REPLY, TEMPLATE_REPLY, TRIVIAL_REASON
from ..operators.clustering import CLUSTER_COUNTS, SILHOUETTE_ROWS
from ..operators.metrics import RUBRIC_DIMENSIONS
from ..operators.model_call import FAILED_INTENT, FAILED_REPLY
from ..operators.sampling import DIFFICULTY_SHARES
from . import fixtures as fx

CHECKS: dict[str, str] = {}


def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def any_of(column: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {q(w)})" for w in words) + ")"


def listing(values: Sequence[str]) -> str:
    return ", ".join(q(v) for v in values)


def with_(views: Sequence[str], body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(VIEWS[v] for v in views) + "\n" + body


def count_char(column: str, char: str) -> str:
    return f"(length({column}) - length(replace({column}, {q(char)}, '')))"


SPACES = f"[{tx.SPACE}]"
CLEAN = (
    f"trim(regexp_replace(replace(replace(replace(regexp_replace(coalesce(text, ''), '@{tx.WORD}+', '', 'g'), "
    + "), ".join(f"{q(k)}, {q(v)}" for k, v in tx.PLACEHOLDERS.items())
    + f"), '{SPACES}+', ' ', 'g'), ' ')"
)
WORDS = f"length(regexp_extract_all(text, '[^{tx.SPACE}]+'))"
PHRASE_CASE = "CASE {0} % " + str(len(fx.PHRASES)) + " " + " ".join(
    f"WHEN {i} THEN {q(p)}" for i, p in enumerate(fx.PHRASES)) + " END"
TAXONOMY_ROWS = ", ".join(
    f"({cid}, {q(label)}, {q(desc)}, [{listing(words)}]::VARCHAR[], {str(flag).lower()})"
    for cid, label, desc, words, flag in fx.TAXONOMY)


def first_keyword_sql(column: str, groups: dict[str, Sequence[str]], match: str = "substring") -> str:
    """CASE giving 'category|keyword' of the first hit."""
    arms = []
    for category, words in groups.items():
        for word in words:
            test = (f"contains({column}, {q(word)})" if match == "substring"
                    else f"regexp_matches({column}, '(^|[^\\p{{L}}\\p{{N}}_]){word}($|[^\\p{{L}}\\p{{N}}_])')")
            arms.append(f"WHEN {test} THEN {q(category + '|' + word)}")
    return "CASE " + " ".join(arms) + " END"


def difficulty_sql(text: str, turns: str) -> str:
    low, bang, ask = f"lower({text})", count_char(text, "!"), count_char(text, "?")
    words = f"length(regexp_extract_all({text}, '[^{tx.SPACE}]+'))"
    hard = " + ".join(f"({c})::INT" for c in [
        f"{words} > 40", any_of(low, tx.MULTI_ISSUE_WORDS), any_of(low, tx.EMOTION_WORDS), f"{ask} > 0 AND {bang} > 0",
        f"{bang} > 2", any_of(low, tx.SLANG_WORDS), f"coalesce({turns}, 0) > 4"])
    easy = " + ".join(f"({c})::INT" for c in [f"{words} < 15", any_of(low, tx.HOW_TO_WORDS), f"{ask} = 1 AND {bang} = 0"])
    return f"CASE WHEN {hard} >= 2 THEN 'hard' WHEN {easy} >= 2 THEN 'easy' ELSE 'medium' END"


def adversarial_sql(text: str) -> str:
    low = f"lower({text})"
    bare = f"regexp_replace(regexp_replace({text}, '[^\\p{{L}}\\p{{N}}_{tx.SPACE}]', '', 'g'), '^{SPACES}+|{SPACES}+$', '', 'g')"
    return (
        f"(({any_of(low, tx.PRAISE_WORDS)} AND {any_of(low, tx.FAILURE_WORDS)}) OR {any_of(low, tx.OFF_TOPIC_WORDS)} "
        f"OR regexp_matches({text}, '[^\\x00-\\x7F]{{3,}}') OR length(regexp_extract_all({text}, '[^{tx.SPACE}]+')) <= 3 "
        f"OR length({bare}) < 5 OR {count_char(text, '@')} > 2)"
    )


def draw(seed: str, column: str) -> str:
    return f"md5({q(seed + ':')} || {column})"


def number(seed: str, column: str, below: int) -> str:
    return f"(('0x' || substr({draw(seed, column)}, 1, 8))::BIGINT % {below})"


VIEWS = {
    "posts": f"""posts AS (
        SELECT (conv_id * {fx.CONV_STEP} + turn)::VARCHAR || CASE WHEN turn % 3 = 1 THEN '.0' ELSE '' END AS tweet_id,
            CASE WHEN role = 'assistant' THEN 'brand' || (conv_id % 3) ELSE 'u' || conv_id END AS author_id,
            role = 'user' AS inbound,
            strftime(make_timestamp(({fx.FIRST_SECOND} + conv_id * 977 + turn * 61) * 1000000), '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
            CASE WHEN turn % 4 = 0 THEN '@brand' || (conv_id % 3) || ' ' ELSE '' END || text
                || CASE WHEN turn % 5 = 1 THEN ' __url__' ELSE '' END
                || CASE WHEN turn % 2 = 0 THEN {PHRASE_CASE.format('(conv_id // 3)')} ELSE '' END AS text,
            concat_ws(',',
                CASE WHEN conv_id % 4 = 0 THEN (conv_id * {fx.CONV_STEP} + 2 * turn + 1) || ', ' || (conv_id * {fx.CONV_STEP} + 2 * turn + 2)
                    ELSE (conv_id * {fx.CONV_STEP} + turn + 1)::VARCHAR END,
                CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN ((conv_id + 1) * {fx.CONV_STEP})::VARCHAR END,
                CASE WHEN conv_id % 11 = 0 AND turn = 2 THEN ((conv_id + 1) * {fx.CONV_STEP} + 1)::VARCHAR END,
                CASE WHEN conv_id % 13 = 0 AND turn = 2 THEN (conv_id * {fx.CONV_STEP} + turn - 1)::VARCHAR END,
                CASE WHEN turn % 6 = 5 THEN 'x' END) AS response_tweet_id,
            CASE WHEN turn > 0 THEN (CASE WHEN conv_id % 4 = 0 THEN conv_id * {fx.CONV_STEP} + (turn - 1) // 2
                ELSE conv_id * {fx.CONV_STEP} + turn - 1 END)::VARCHAR || '.0' END AS in_response_to_tweet_id
        FROM conversations WHERE role <> 'system')""",
    "ids": """ids AS (
        SELECT *, coalesce(trunc(try_cast(tweet_id AS DOUBLE))::BIGINT, -1) AS tid,
            coalesce(trunc(try_cast(in_response_to_tweet_id AS DOUBLE))::BIGINT, -1) AS parent_id,
            epoch(strptime(created_at, '%a %b %d %H:%M:%S %z %Y'))::BIGINT AS secs
        FROM posts)""",
    "listed": """listed AS (
        SELECT tid AS src, coalesce(trunc(try_cast(trim(item) AS DOUBLE))::BIGINT, -1) AS dst
        FROM (SELECT tid, unnest(string_split(response_tweet_id, ',')) AS item FROM ids))""",
    "edges": """edges AS (
        SELECT parent_id AS src, tid AS dst FROM ids WHERE parent_id IN (SELECT tid FROM ids)
        UNION SELECT src, dst FROM listed WHERE dst IN (SELECT tid FROM ids))""",
    "roots": """roots AS (SELECT * FROM ids WHERE inbound AND parent_id NOT IN (SELECT tid FROM ids))""",
    "reach": """reach(root, node) AS (
        SELECT tid, tid FROM roots UNION SELECT reach.root, edges.dst FROM reach JOIN edges ON edges.src = reach.node)""",
    "owner": """owner AS (
        SELECT node AS tid, root AS thread_id FROM (
            SELECT node, root, row_number() OVER (PARTITION BY node ORDER BY r.secs, r.tid) AS n
            FROM reach JOIN roots r ON r.tid = reach.root) WHERE n = 1)""",
    "owner_lexical": """owner AS (
        SELECT node AS tid, root AS thread_id FROM (
            SELECT node, root, row_number() OVER (PARTITION BY node ORDER BY r.created_at, r.tid) AS n
            FROM reach JOIN roots r ON r.tid = reach.root) WHERE n = 1)""",
    "thread_messages": f"""thread_messages AS (
        SELECT thread_id, ids.tid, tweet_id, author_id, secs, created_at,
            CASE WHEN inbound THEN 'customer' ELSE 'agent' END AS role, {CLEAN} AS text,
            row_number() OVER (PARTITION BY thread_id ORDER BY secs, ids.tid) AS place,
            row_number() OVER (PARTITION BY thread_id ORDER BY created_at, ids.tid) AS text_place
        FROM owner JOIN ids ON ids.tid = owner.tid)""",
    "threads": """threads AS (
        SELECT thread_id, count(*) AS num_turns, count(*) FILTER (role = 'customer') AS num_customer_msgs,
            count(*) FILTER (role = 'agent') AS num_agent_msgs,
            arg_min(text, place) FILTER (role = 'customer') AS customer_first_message,
            arg_min(text, place) FILTER (role = 'agent') AS agent_first_response
        FROM thread_messages GROUP BY thread_id)""",
    "threads_lexical": """threads AS (
        SELECT thread_id, count(*) AS num_turns, count(*) FILTER (role = 'customer') AS num_customer_msgs,
            count(*) FILTER (role = 'agent') AS num_agent_msgs,
            arg_min(text, text_place) FILTER (role = 'customer') AS customer_first_message,
            arg_min(text, text_place) FILTER (role = 'agent') AS agent_first_response
        FROM thread_messages GROUP BY thread_id)""",
    "complete": """complete AS (SELECT * FROM threads WHERE num_turns >= 2 AND num_customer_msgs > 0 AND num_agent_msgs > 0)""",
    "all_posts": "",
    "messages": f"""messages AS (
        SELECT doc_id AS id, text || {PHRASE_CASE.format('doc_id')} AS text, doc_id % 8 AS num_turns,
            CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'Answer ' || doc_id END AS agent_response, e.label AS cluster_id
        FROM documents LEFT JOIN embeddings e ON e.vec_id = doc_id)""",
    "taxonomy": f"""taxonomy AS (
        SELECT * FROM (VALUES {TAXONOMY_ROWS}) t(cluster_id, intent_label, description, keywords, flag))""",
    "with_intent": """with_intent AS (
        SELECT m.*, coalesce(t.intent_label, 'unknown') AS intent,
            coalesce(t.intent_label, 'cluster_' || m.cluster_id) AS label_or_cluster
        FROM messages m LEFT JOIN taxonomy t ON t.cluster_id = m.cluster_id)""",
    "ruled": f"""ruled AS (
        SELECT *, {first_keyword_sql('lower(text)', rules.ESCALATION_RULES)} AS hit,
            intent IN (SELECT intent_label FROM taxonomy WHERE flag) AS flagged FROM with_intent)""",
    "gold": """gold AS (
        SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'abuse' WHEN quality = 1 THEN 'question' ELSE 'noise' END AS gold_intent,
            CASE WHEN toxic = 1 THEN 'escalate' ELSE 'auto_handle' END AS gold_escalation FROM labels)""",
    "preds": f"""preds AS (
        SELECT '{fx.SYSTEM_BY_LENGTH}' AS system, doc_id AS id,
            CASE WHEN n_chars < 500 THEN 'noise' WHEN n_chars < 3000 THEN 'question' ELSE 'rant' END AS pred_intent,
            CASE WHEN n_chars % 3 = 0 THEN 'escalate' ELSE 'auto_handle' END AS pred_escalation FROM documents
        UNION ALL SELECT '{fx.SYSTEM_BY_WORDS}', doc_id,
            CASE WHEN doc_id % 10 = 0 THEN 'unknown' WHEN contains(lower(text), 'thin') THEN 'abuse' ELSE 'question' END,
            CASE WHEN contains(lower(text), 'sue') THEN 'escalate' ELSE 'auto_handle' END FROM documents
        UNION ALL SELECT '{fx.SYSTEM_MAJORITY}', doc_id, 'question', 'auto_handle' FROM documents)""",
    "aligned": "aligned AS (SELECT * FROM preds JOIN gold USING (id))",
    "label_rows": """label_rows AS (
        SELECT system, gold_intent AS label FROM aligned UNION SELECT system, pred_intent FROM aligned)""",
    "classes": """classes AS (
        SELECT l.system, l.label, sum((a.gold_intent = l.label AND a.pred_intent = l.label)::INT) AS tp,
            sum((a.gold_intent = l.label)::INT) AS support, sum((a.pred_intent = l.label)::INT) AS predicted
        FROM label_rows l JOIN aligned a ON a.system = l.system GROUP BY ALL)""",
    "f1s": """f1s AS (
        SELECT system, label, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r, support,
            2.0::DOUBLE * tp / (support + predicted) AS f1 FROM classes)""",
    "esc": """esc AS (
        SELECT system, count(*) AS n, count(*) FILTER (gold_escalation = pred_escalation) AS same,
            count(*) FILTER (gold_escalation = 'escalate' AND pred_escalation = 'escalate') AS tp,
            count(*) FILTER (gold_escalation <> 'escalate' AND pred_escalation = 'escalate') AS fp,
            count(*) FILTER (gold_escalation = 'escalate' AND pred_escalation <> 'escalate') AS fn,
            count(*) FILTER (gold_escalation <> 'escalate' AND pred_escalation <> 'escalate') AS tn
        FROM aligned GROUP BY system)""",
    "scores": """scores AS (
        SELECT event_id AS id, event_type AS dim, k, (k % 6)::DOUBLE AS score,
            CASE WHEN event_id % 19 <> 0 THEN (floor(value)::BIGINT % 5 + 1)::DOUBLE END AS human, (k % 5 + 1)::DOUBLE AS judge,
            CASE WHEN event_id % 11 <> 0 THEN CASE WHEN event_id % 9 = 0 THEN 0.0 ELSE (k % 41) / 8.0 END END::DOUBLE AS overall_score,
            ['easy', 'medium', 'hard', 'unknown'][user_id % 4 + 1] AS difficulty
        FROM (SELECT *, json_extract(props, '$.k')::BIGINT AS k FROM events))""",
    "pairs": "pairs AS (SELECT * FROM scores WHERE human IS NOT NULL AND judge IS NOT NULL)",
    "lengths": """lengths AS (
        SELECT conv_id AS thread_id, count(*) AS num_turns FROM conversations WHERE role <> 'system' GROUP BY conv_id)""",
    "bucketed": """bucketed AS (
        SELECT *, CASE WHEN num_turns <= 3 THEN 'short' WHEN num_turns <= 6 THEN 'medium' ELSE 'long' END AS bucket FROM lengths)""",
    "candidates": f"""candidates AS (
        SELECT id, text, agent_response, intent, {difficulty_sql('text', 'num_turns')} AS difficulty, {adversarial_sql('text')} AS is_adversarial,
            {draw('42', 'id')} AS draw FROM with_intent)""",
    "quotas": f"""quotas AS (
        SELECT difficulty, greatest(1, floor((SELECT 180 // greatest(count(DISTINCT intent), 1) FROM candidates) * share)) AS quota
        FROM (VALUES {', '.join(f"('{k}', {v}::DOUBLE)" for k, v in DIFFICULTY_SHARES.items())}) s(difficulty, share))""",
    "phase1": """phase1 AS (
        SELECT id, text, agent_response, intent, difficulty, is_adversarial, draw, 1 AS phase FROM (
            SELECT c.*, row_number() OVER (PARTITION BY intent, c.difficulty ORDER BY draw, id) AS n, quota
            FROM candidates c JOIN quotas USING (difficulty)) WHERE n <= quota)""",
    "phase2": """phase2 AS (
        SELECT id, text, agent_response, intent, 'hard' AS difficulty, is_adversarial, draw, 2 AS phase FROM candidates
        WHERE is_adversarial AND id NOT IN (SELECT id FROM phase1) ORDER BY draw, id LIMIT 20)""",
    "phase3": """phase3 AS (
        SELECT id, text, agent_response, intent, difficulty, is_adversarial, draw, 3 AS phase FROM (
            SELECT *, row_number() OVER (ORDER BY draw, id) AS n FROM candidates
            WHERE id NOT IN (SELECT id FROM phase1) AND id NOT IN (SELECT id FROM phase2))
        WHERE n <= 200 - (SELECT count(*) FROM phase1) - (SELECT count(*) FROM phase2))""",
    "chosen": """chosen AS (
        SELECT * FROM (SELECT * FROM phase1 UNION ALL SELECT * FROM phase2 UNION ALL SELECT * FROM phase3)
        ORDER BY phase, draw, id LIMIT 200)""",
    "clustered": """clustered AS (
        SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY md5((cluster_id + 42) || ':' || id), id) AS place
        FROM messages WHERE cluster_id IS NOT NULL)""",
    "units": """units AS (
        SELECT vec_id, list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + 1e-8)) AS u
        FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))""",
    "nearest": """nearest AS (
        SELECT * FROM (
            SELECT query_id, corpus_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS rank
            FROM (SELECT a.vec_id AS query_id, b.vec_id AS corpus_id, round(list_dot_product(a.u, b.u), 9) AS score
                FROM units a, units b WHERE {where})) WHERE rank <= 5)""",
    "tokens": f"""tokens AS (
        SELECT id, list_filter(regexp_extract_all(lower(text), '{tx.WORD}{{2,}}'), lambda t: t NOT IN ({listing(fx.STOP_WORDS)})) AS w FROM source)""",
    "terms": """terms AS (
        SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM tokens)""",
    "vocabulary": """vocabulary AS (
        SELECT term, ln((1 + (SELECT count(*) FROM source)) / (1 + df)) + 1 AS idf FROM (
            SELECT term, count(*) AS total, count(DISTINCT id) AS df FROM terms GROUP BY term ORDER BY total DESC, term LIMIT 5000))""",
    "weights": """weights AS (
        SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight
        FROM (SELECT id, term, count(*) * any_value(idf) AS raw FROM terms JOIN vocabulary USING (term) GROUP BY id, term))""",
    "source_documents": "source AS (SELECT doc_id AS id, text FROM documents)",
    "source_messages": "source AS (SELECT id, text FROM messages)",
    "q_tokens": f"""q_tokens AS (
        SELECT item_id, list_filter(regexp_extract_all(lower(text), '{tx.WORD}{{2,}}'), lambda t: t NOT IN ({listing(fx.STOP_WORDS)})) AS w FROM benchmark)""",
    "q_terms": """q_terms AS (
        SELECT item_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM q_tokens)""",
    "q_weights": """q_weights AS (
        SELECT item_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)) AS weight
        FROM (SELECT item_id, term, count(*) * any_value(idf) AS raw FROM q_terms JOIN vocabulary USING (term) GROUP BY item_id, term))""",
    "labelled": "labelled AS (SELECT * FROM messages JOIN gold USING (id))",
    "majority": """majority AS (
        SELECT gold_intent AS label FROM labelled GROUP BY gold_intent ORDER BY count(*) DESC, gold_intent LIMIT 1)""",
    "vector_messages": "vector_messages AS (SELECT m.* FROM messages m JOIN embeddings e ON e.vec_id = m.id)",
    "grounding": f"""grounding AS (
        SELECT query_id AS id, string_agg('#' || rank || ', score ' || printf('%.2f', score) || ': to "' || text
                || '", {fx.BRAND} answered "' || agent_response || '"', chr(10) ORDER BY rank) AS shown,
            string_agg(corpus_id::VARCHAR, ',' ORDER BY rank) AS sources,
            string_agg(corpus_id::VARCHAR, ',' ORDER BY rank) FILTER (rank <= 3) AS similar_ids
        FROM nearest JOIN vector_messages m ON m.id = corpus_id GROUP BY query_id)""",
    "rendered": f"""rendered AS (
        SELECT string_agg('[' || intent_label || '] ' || description
                || CASE WHEN len(keywords) > 0 THEN '; words: ' || array_to_string(keywords[1:{prompts.SHOWN_KEYWORDS}], '/') ELSE '' END
                || '; customers write "' || substr(repeat('example ' || cluster_id || ' ', 8), 1, {prompts.EXAMPLE_CHARS}) || '" or "short one"',
                chr(10) ORDER BY cluster_id) AS intents_text, string_agg(intent_label, ', ' ORDER BY cluster_id) AS labels_text
        FROM taxonomy)""",
    "topics": "topics AS (SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {q(name)}, [{listing(words)}])" for i, (name, words) in enumerate(rules.TOPIC_KEYWORDS.items())) + ") t(n, topic, words))",
    "named": """named AS (
        SELECT cluster_id, string_agg(lower(text), ' ' ORDER BY place) AS all_text,
            md5(string_agg(text, chr(10) ORDER BY place) FILTER (place <= 3)) AS examples
        FROM clustered WHERE place <= 20 GROUP BY cluster_id)""",
    "topic_of": """topic_of AS (
        SELECT cluster_id, examples, coalesce(arg_max(topic, hits * 100 - n) FILTER (hits > 0), 'other') AS intent_label
        FROM (SELECT named.*, n, topic, len(list_filter(words, lambda w: contains(all_text, w))) AS hits FROM named, topics)
        GROUP BY cluster_id, examples)""",
    "sizes": "sizes AS (SELECT cluster_id, count(*) AS cluster_size FROM messages WHERE cluster_id IS NOT NULL GROUP BY cluster_id)",
    "compared": f"compared AS (SELECT * FROM embeddings ORDER BY {draw('42', 'vec_id')}, vec_id LIMIT {SILHOUETTE_ROWS})",
    "distances": """distances AS (
        SELECT a.vec_id AS id, a.label AS cluster, b.label AS other, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS total, count(*) AS n
        FROM compared a, compared b GROUP BY ALL)""",
    "quota": """quota AS (
        SELECT least(s, floor(5000 * s / total)) + least(m, floor(5000 * m / total)) + least(l, 5000 - least(s, floor(5000 * s / total)) - least(m, floor(5000 * m / total))) AS sampled
        FROM (SELECT count(*) AS total, count(*) FILTER (num_turns <= 3) AS s, count(*) FILTER (num_turns BETWEEN 4 AND 6) AS m,
            count(*) FILTER (num_turns > 6) AS l FROM complete))""",
}
del VIEWS["all_posts"]
VIEWS["nearest_all"] = VIEWS["nearest"].format(where="true")
# Neighbours among the messages, i.e. vectors that have a text.
VIEWS["message_units"] = VIEWS["units"].replace("FROM embeddings))", "FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)))")
VIEWS["nearest_others"] = VIEWS["nearest"].format(where="a.vec_id <> b.vec_id")

POSTS = ["posts", "ids"]
GRAPH = [*POSTS, "listed", "edges", "roots", "reach", "owner"]
THREADS = [*GRAPH, "thread_messages", "threads"]
LEXICAL = [*POSTS, "listed", "edges", "roots", "reach", "owner_lexical", "thread_messages", "threads_lexical"]
INTENTS = ["messages", "taxonomy", "with_intent"]
ALIGNED = ["gold", "preds", "aligned"]
CHOSEN = [*INTENTS, "candidates", "quotas", "phase1", "phase2", "phase3", "chosen"]
NEAR = ["messages", "vector_messages", "message_units", "nearest_others", "grounding"]
BRAND = f"""posts_all AS (SELECT *, {VIEWS['ids'][VIEWS['ids'].index('coalesce'):VIEWS['ids'].rindex('FROM posts')]} FROM posts),
related AS (SELECT tweet_id, author_id, inbound, created_at, text, response_tweet_id, in_response_to_tweet_id FROM posts_all
    WHERE author_id = '{fx.BRAND}' OR (inbound AND (
        tid IN (SELECT parent_id FROM posts_all WHERE author_id = '{fx.BRAND}' AND parent_id >= 0)
        OR parent_id IN (SELECT tid FROM posts_all WHERE author_id = '{fx.BRAND}'))))"""
VIEWS["brand"] = BRAND
VIEWS["brand_ids"] = VIEWS["ids"].replace("FROM posts)", "FROM related)")
BRAND_THREADS = ["posts", "brand", "brand_ids", "listed", "edges", "roots", "reach", "owner", "thread_messages", "threads", "complete"]
DECISION = "decision, reason, confidence, trigger"


def decision_sql(hit: str, source: str, *keep: str) -> str:
    columns = "".join(f"{k}, " for k in keep)
    return f"""SELECT {columns}CASE WHEN hit IS NOT NULL THEN 'escalate' END AS decision,
        'Triggered by ' || split_part(hit, '|', 1) || ' keyword: ''' || split_part(hit, '|', 2) || '''' AS reason,
        CASE WHEN hit IS NOT NULL THEN {rules.RULE_CONFIDENCE}::DOUBLE END AS confidence,
        CASE WHEN hit IS NOT NULL THEN 'rule' END AS trigger FROM (SELECT *, {hit} AS hit FROM {source})"""


TEXT = "md5({0}) AS text_md5, length({0}) AS text_chars"
PAGE_LINE = "concat_ws(':', place::VARCHAR, role, tweet_id, author_id, text)"

# --- text and scalars ---------------------------------------------------------
CHECKS["clean_text"] = with_(["posts"], f"SELECT tweet_id, {CLEAN} AS clean FROM posts")
CHECKS["extract_mentions"] = with_(["posts"], f"""SELECT tweet_id, array_to_string(m, '|') AS mentions, len(m) AS n_mentions
    FROM (SELECT tweet_id, regexp_extract_all(text, '@({tx.WORD}+)', 1) AS m FROM posts)""")
CHECKS["normalize_id"] = """SELECT event_id, raw, CASE event_id % 9 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 2 THEN event_id
        WHEN 6 THEN 1234567890000000000 + event_id WHEN 7 THEN -event_id ELSE -1 END AS norm FROM (
    SELECT event_id, CASE event_id % 9 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_id || '.0' WHEN 2 THEN event_id || '.9'
        WHEN 3 THEN 'x' WHEN 4 THEN '' WHEN 5 THEN event_id || 'd' WHEN 6 THEN (1234567890000000000 + event_id)::VARCHAR
        WHEN 7 THEN '-' || event_id || '.5' END AS raw FROM events)"""
CHECKS["post_time"] = with_(POSTS, "SELECT tweet_id, secs AS seconds FROM ids")
CHECKS["text_profile"] = with_(["messages"], f"""SELECT id, {WORDS} AS words, {count_char('text', '!')} AS exclaims, {count_char('text', '?')} AS questions FROM messages""")
CHECKS["difficulty"] = with_(["messages"], f"SELECT id, {difficulty_sql('text', 'num_turns')} AS difficulty FROM messages")
CHECKS["adversarial"] = with_(["messages"], f"SELECT id, {adversarial_sql('text')} AS is_adversarial FROM messages")
CHECKS["length_bucket"] = with_(["lengths", "bucketed"], "SELECT * FROM bucketed")
CHECKS["min_length"] = "SELECT conv_id, turn, length(text) AS chars FROM conversations WHERE length(text) > 10"
CHECKS["score_bins"] = with_(["scores"], """SELECT dim, CASE WHEN score <= 2 THEN 'low' WHEN score <= 3 THEN 'mid' ELSE 'high' END AS bin, count(*) AS n
    FROM scores GROUP BY ALL""")

# --- threads ------------------------------------------------------------------
CHECKS["brand_posts"] = with_(["posts", "brand", "brand_ids"], "SELECT tid, parent_id, author_id, inbound FROM ids")
CHECKS["reply_edges"] = with_([*POSTS, "listed", "edges"], "SELECT src, dst FROM edges")
CHECKS["thread_roots"] = with_([*POSTS, "roots"], "SELECT tid, author_id FROM roots")
CHECKS["thread_owner"] = with_(GRAPH, "SELECT tid, thread_id FROM owner", True)
CHECKS["thread_owner_lexical"] = with_(LEXICAL[:-2], "SELECT tid, thread_id FROM owner", True)
CHECKS["thread_summaries"] = with_(THREADS, "SELECT * FROM threads", True)
CHECKS["complete_threads"] = with_([*THREADS, "complete"], "SELECT thread_id, num_turns, num_customer_msgs, num_agent_msgs FROM complete", True)
CHECKS["first_messages"] = with_([*THREADS, "complete"], "SELECT thread_id, customer_first_message, agent_first_response FROM complete", True)
CHECKS["first_messages_lexical"] = with_([*LEXICAL, "complete"], "SELECT thread_id, customer_first_message, agent_first_response FROM complete", True)
CHECKS["thread_pages"] = with_([*GRAPH, "thread_messages"], f"""SELECT thread_id, (place - 1) // 200 AS page, count(*) AS n,
    md5(string_agg({PAGE_LINE}, chr(10) ORDER BY place)) AS content FROM thread_messages GROUP BY ALL""", True)
CHECKS["thread_rows"] = with_(THREADS, """SELECT thread_id, (place - 1) // 200 AS page, count(*) AS n, num_turns, num_customer_msgs, num_agent_msgs,
    customer_first_message, agent_first_response, string_agg(role, ',' ORDER BY place) AS roles
    FROM thread_messages JOIN threads USING (thread_id) GROUP BY ALL""", True)
CHECKS["context_slice"] = with_([*GRAPH, "thread_messages"], """SELECT thread_id,
    string_agg(concat_ws(':', place::VARCHAR, role, text), chr(10) ORDER BY place) AS context FROM thread_messages WHERE place <= 6 GROUP BY thread_id""", True)
CHECKS["customer_messages"] = with_([*THREADS, "complete"], """SELECT thread_id, customer_first_message AS text, agent_first_response AS agent_response, num_turns
    FROM complete WHERE length(customer_first_message) > 10""", True)
CHECKS["thread_stats"] = with_([*THREADS, "complete"], """SELECT count(*) AS threads, round_even(avg(num_turns), 2) AS avg_turns,
    min(num_turns) AS min_turns, max(num_turns) AS max_turns FROM complete""", True)
CHECKS["funnel"] = with_([*BRAND_THREADS, "quota"], """SELECT 'raw_posts' AS step, count(*) AS n FROM posts
    UNION ALL SELECT 'brand_posts', count(*) FROM ids UNION ALL SELECT 'complete_threads', count(*) FROM complete
    UNION ALL SELECT 'sampled_threads', sampled::BIGINT FROM quota
    UNION ALL SELECT 'threads_' || CASE WHEN num_turns <= 3 THEN 'short' WHEN num_turns <= 6 THEN 'medium' ELSE 'long' END, count(*) FROM complete GROUP BY 1""", True)
CHECKS["brand_triage"] = with_(BRAND_THREADS, f"""SELECT CASE WHEN hit IS NULL THEN 'undecided' ELSE 'escalate' END AS decision,
    CASE WHEN hit IS NULL THEN 'none' ELSE 'rule' END AS trigger, count(*) AS n
    FROM (SELECT {first_keyword_sql('lower(customer_first_message)', rules.ESCALATION_RULES)} AS hit FROM complete WHERE length(customer_first_message) > 10)
    GROUP BY ALL""", True)

# --- rules --------------------------------------------------------------------
CHECKS["rule_escalation"] = with_(["messages"], decision_sql(first_keyword_sql("lower(text)", rules.ESCALATION_RULES), "messages", "id"))
CHECKS["rule_escalation_word"] = with_(["messages"], decision_sql(first_keyword_sql("lower(text)", rules.ESCALATION_RULES, "word"), "messages", "id"))
KEYWORD_REASON = f"CASE WHEN hit IS NULL THEN {q(rules.KEYWORD_MISS_REASON)} ELSE 'Keyword trigger: ''' || split_part(hit, '|', 2) || '''' END"
VIEWS["source_labelled"] = "source AS (SELECT id, text FROM labelled)"
# The closest other labelled message of each; the lowest id where none shares a term.
VIEWS["closest"] = f"""closest AS (
    SELECT q.id, CASE WHEN score > 0 AND m.agent_response <> '' THEN m.agent_response ELSE {q(EMPTY_REPLY)} END AS reply FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS n FROM (
            SELECT a.id, b.id AS other, coalesce(s.score, 0) AS score FROM labelled a JOIN labelled b ON a.id <> b.id LEFT JOIN (
                SELECT v.id, w.id AS other, round(sum(w.weight * v.weight), 9) AS score FROM weights v JOIN weights w USING (term) GROUP BY ALL) s
                ON s.id = a.id AND s.other = b.id)) q JOIN labelled m ON m.id = q.other WHERE n = 1)"""
VIEWS["keyworded"] = f"""keyworded AS (SELECT *, CASE WHEN hit IS NULL THEN 'auto_handle' ELSE 'escalate' END AS decision
    FROM (SELECT *, {first_keyword_sql('lower(text)', {'keyword': rules.BASELINE_WORDS})} AS hit FROM labelled))"""
CHECKS["keyword_escalation"] = with_(["messages"], f"""SELECT id, CASE WHEN hit IS NULL THEN 'auto_handle' ELSE 'escalate' END AS decision,
    CASE WHEN hit IS NULL THEN {q(rules.KEYWORD_MISS_REASON)} ELSE 'Keyword trigger: ''' || split_part(hit, '|', 2) || '''' END AS reason,
    CASE WHEN hit IS NULL THEN 0.6::DOUBLE ELSE 0.8::DOUBLE END AS confidence, 'keyword' AS trigger
    FROM (SELECT id, {first_keyword_sql('lower(text)', {'keyword': rules.BASELINE_WORDS})} AS hit FROM messages)""")
CHECKS["intent_mapping"] = with_(INTENTS, "SELECT id, intent, label_or_cluster FROM with_intent")
FLAG_REASON = "'Intent ''' || intent || ''' is flagged as typically needing human review'"
CHECKS["taxonomy_escalation"] = with_([*INTENTS, "ruled"], f"""SELECT id, intent, CASE WHEN flagged THEN 'escalate' END AS decision,
    CASE WHEN flagged THEN {FLAG_REASON} END AS reason, CASE WHEN flagged THEN 0.7::DOUBLE END AS confidence,
    CASE WHEN flagged THEN 'taxonomy' END AS trigger FROM ruled""")
CHECKS["three_phase"] = with_([*INTENTS, "ruled"], f"""SELECT id,
    CASE WHEN hit IS NOT NULL OR flagged OR id % 5 = 0 OR id % 2 = 1 THEN 'escalate' ELSE 'auto_handle' END AS decision,
    CASE WHEN hit IS NOT NULL THEN 'Triggered by ' || split_part(hit, '|', 1) || ' keyword: ''' || split_part(hit, '|', 2) || ''''
        WHEN flagged THEN {FLAG_REASON} WHEN id % 5 <> 0 THEN 'because ' || id ELSE {q(rules.FALLBACK_REASON)} END AS reason,
    CASE WHEN hit IS NOT NULL THEN 0.95 WHEN flagged THEN 0.7 WHEN id % 5 <> 0 THEN 0.5 ELSE 0.3 END::DOUBLE AS confidence,
    CASE WHEN hit IS NOT NULL THEN 'rule' WHEN flagged THEN 'taxonomy' WHEN id % 5 <> 0 THEN 'llm' ELSE 'fallback' END AS trigger FROM ruled""")
CHECKS["closest_label"] = f"""SELECT id, given, CASE WHEN given IN (SELECT unnest([{listing(fx.LABELS)}])) THEN given ELSE coalesce(
        (SELECT arg_min(l, n) FROM (SELECT unnest([{listing(fx.LABELS)}]) AS l, unnest(range({len(fx.LABELS)})) AS n)
            WHERE contains(norm, l) OR contains(l, norm)), {q(fx.LABELS[0])}) END AS label
    FROM (SELECT *, replace(lower(coalesce(given, '')), ' ', '_') AS norm FROM (
        SELECT doc_id AS id, CASE doc_id % 6 WHEN 0 THEN 'battery_charging_issue' WHEN 1 THEN 'Media Services Issue (music)'
        WHEN 2 THEN 'storage' WHEN 3 THEN '' WHEN 4 THEN 'thing ' || doc_id END AS given FROM documents))"""
HITS = {i: " + ".join([f"contains(lower(text), {q(w.lower())})::INT" for w in words] or ["0"]) for i, (_, words) in enumerate(fx.INTENT_KEYWORDS)}
CHECKS["weak_labels"] = with_(["messages"], f"""SELECT id, gold_intent,
    CASE WHEN hit IS NOT NULL OR coin THEN 'escalate' ELSE 'auto_handle' END AS gold_escalation,
    CASE WHEN hit IS NOT NULL THEN 'Contains high-priority keyword: ''' || split_part(hit, '|', 2) || ''''
        WHEN coin THEN 'Intent ''' || gold_intent || ''' typically requires human empathy/review'
        ELSE {q(rules.WEAK_STANDARD_REASON)} END AS gold_escalation_reason
    FROM (SELECT *, gold_intent IN ({listing(rules.EMPATHY_LABELS)}) AND {number('42:escalate', 'id', 2)} = 1 AS coin FROM (
        SELECT id, {first_keyword_sql('lower(text)', {'w': rules.WEAK_LABEL_WORDS})} AS hit,
            CASE WHEN list_max(hits) = 0 THEN [{listing(rules.GENERIC_LABELS)}][{number('42:intent', 'id', 3)} + 1]
                ELSE [{listing([label for label, _ in fx.INTENT_KEYWORDS])}][list_position(hits, list_max(hits))] END AS gold_intent
        FROM (SELECT id, text, [{', '.join(HITS.values())}] AS hits FROM messages)))""")
# In the taxonomy table a label that two clusters share is one intent with the keywords of both.
MERGED: dict[str, list[str]] = {}
for _, label, _, words, _ in fx.TAXONOMY:
    MERGED.setdefault(label, []).extend(w for w in words if w not in MERGED.get(label, []))
_MERGED_HITS = ", ".join("(" + " + ".join(["0", *[f"contains(lower(text), {q(w.lower())})::INT" for w in words]]) + ")" for words in MERGED.values())
CHECKS["weak_labels_taxonomy"] = with_(["messages"], f"""SELECT id, gold_intent, CASE WHEN hit IS NOT NULL OR (gold_intent IN ({listing(rules.EMPATHY_LABELS)})
        AND {number('42:escalate', 'id', 2)} = 1) THEN 'escalate' ELSE 'auto_handle' END AS gold_escalation FROM (
    SELECT id, {first_keyword_sql('lower(text)', {'w': rules.WEAK_LABEL_WORDS})} AS hit,
        CASE WHEN list_max(hits) = 0 THEN [{listing(rules.GENERIC_LABELS)}][{number('42:intent', 'id', 3)} + 1]
            ELSE [{listing(list(MERGED))}][list_position(hits, list_max(hits))] END AS gold_intent
    FROM (SELECT id, text, [{_MERGED_HITS}] AS hits FROM messages))""")
TOPICS = ["messages", "clustered", "named", "topics", "topic_of", "sizes"]
CHECKS["cluster_topic"] = with_(TOPICS, """SELECT cluster_id::BIGINT AS cluster_id, intent_label,
    'Cluster ' || cluster_id || ' (' || cluster_size || ' messages)' AS description, cluster_size, examples FROM topic_of JOIN sizes USING (cluster_id)""")
CHECKS["cluster_sizes"] = "SELECT label::BIGINT AS cluster, count(*) AS cluster_size FROM embeddings GROUP BY label"

# --- metrics ------------------------------------------------------------------
CHECKS["prediction_normalize"] = with_(["preds"], "SELECT * FROM preds")
CHECKS["unmatched_ids"] = """SELECT (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS gold_only,
    (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS prediction_only"""
CHECKS["accuracy"] = with_(ALIGNED, """SELECT system, round(avg((gold_intent = pred_intent)::INT), 6) AS accuracy,
    sum((gold_intent = pred_intent)::INT)::BIGINT AS correct, count(*) AS rows FROM aligned GROUP BY system""")
CHECKS["per_class_prf"] = with_([*ALIGNED, "label_rows", "classes", "f1s"], """SELECT system, label, round(p, 6) AS precision, round(r, 6) AS recall,
    round(f1, 6) AS f1, support::BIGINT AS support FROM f1s""")
CHECKS["macro_f1"] = with_([*ALIGNED, "label_rows", "classes", "f1s"], "SELECT system, round(avg(f1), 6) AS macro_f1, count(*) AS labels FROM f1s GROUP BY system")
CHECKS["confusion_long"] = with_(ALIGNED, "SELECT system, gold_intent AS gold, pred_intent AS pred, count(*) AS n FROM aligned GROUP BY ALL")
CHECKS["confusion_dense"] = with_([*ALIGNED, "label_rows"], """SELECT g.system, g.label AS gold, p.label AS pred, count(a.id) AS n
    FROM label_rows g JOIN label_rows p ON p.system = g.system
    LEFT JOIN aligned a ON a.system = g.system AND a.gold_intent = g.label AND a.pred_intent = p.label GROUP BY ALL""")
CHECKS["escalation_metrics"] = with_([*ALIGNED, "esc"], """SELECT system, round(same / n, 6) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS escalation_precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS escalation_recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS escalation_f1, tp, fp, fn, tn FROM esc""")
CHECKS["system_comparison"] = with_([*ALIGNED, "label_rows", "classes", "f1s", "esc"], """SELECT system, round(a, 6) AS intent_accuracy, round(m, 6) AS macro_f1,
    round(same / n, 6) AS escalation_accuracy, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS escalation_recall,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS escalation_precision
    FROM (SELECT system, avg((gold_intent = pred_intent)::INT) AS a FROM aligned GROUP BY system)
    JOIN (SELECT system, avg(f1) AS m FROM f1s GROUP BY system) USING (system) JOIN esc USING (system)""")
CHECKS["judge_summary"] = with_(["scores"], """SELECT dim, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, min(score) AS min, max(score) AS max,
    median(score) AS median, count(*) AS n FROM scores GROUP BY dim""")
CHECKS["judge_by_difficulty"] = with_(["scores"], """SELECT difficulty, round(avg(overall_score), 6) AS mean, round(stddev_pop(overall_score), 6) AS std, count(*) AS n
    FROM (SELECT difficulty, overall_score FROM scores WHERE difficulty <> 'unknown' UNION ALL SELECT 'overall', overall_score FROM scores)
    WHERE overall_score <> 0 GROUP BY difficulty""")
CHECKS["calibration_pairs"] = with_(["scores"], " UNION ALL ".join(
    f"""SELECT id, {q(dim)} AS dim, ((k + {n}) % 5 + 1)::DOUBLE AS human, ((k + {n + 1}) % 5 + 1)::DOUBLE AS judge
    FROM scores WHERE id % 3 <> 0 AND id % 4 <> 0 AND id % 7 <> {n}""" for n, dim in enumerate(RUBRIC_DIMENSIONS[:4])))
CHECKS["pearson_mae"] = with_(["scores", "pairs"], """SELECT dim, round(corr(human, judge), 6) AS pearson_r, round(avg(abs(human - judge)), 6) AS mae,
    count(*) AS n_samples FROM pairs GROUP BY dim HAVING count(*) >= 5""")
BIN = "CASE WHEN {0} <= 2 THEN 'low' WHEN {0} <= 3 THEN 'mid' ELSE 'high' END"
CHECKS["cohen_kappa"] = with_(["scores", "pairs"], f"""SELECT dim, round((seen - chance) / (1 - chance), 6) AS cohens_kappa, n AS n_samples FROM (
    SELECT dim, n, seen, (SELECT sum(h.c * j.c) FROM (SELECT dim, {BIN.format('human')} AS b, count(*) AS c FROM pairs GROUP BY ALL) h
        JOIN (SELECT dim, {BIN.format('judge')} AS b, count(*) AS c FROM pairs GROUP BY ALL) j ON j.dim = h.dim AND j.b = h.b WHERE h.dim = o.dim) / (n * n) AS chance
    FROM (SELECT dim, count(*) AS n, avg(({BIN.format('human')} = {BIN.format('judge')})::INT) AS seen FROM pairs GROUP BY dim) o)""")
# p of a correlation: the share beyond |r| of cos(x)^(n - 3) over 0 to pi/2 (x = asin of the correlation), by Simpson's rule up to where it has vanished.
P_STEPS = 4000


def _tail(begin: str) -> str:
    at = f"({begin} + ({{end}} - {begin}) * i / {P_STEPS}.0::DOUBLE)"
    weight = f"CASE WHEN i = 0 OR i = {P_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(({{end}} - {begin}) * list_sum(list_transform(range({P_STEPS + 1}), lambda i: {weight} * exp((n_samples - 3) * ln(greatest(cos({at}), 1e-300))))))"


_END = "least(pi() / 2, asin(abs(r)) + 12 / sqrt(n_samples - 3))"
CHECKS["judge_calibration"] = with_(["scores", "pairs"], f""", told AS (SELECT dim, corr(human, judge) AS r, avg(abs(human - judge)) AS mae, count(*) AS n_samples FROM pairs GROUP BY dim HAVING count(*) >= 5),
    kappa AS ({CHECKS["cohen_kappa"][CHECKS["cohen_kappa"].index("SELECT dim, round((seen"):]})
    SELECT dim, round(r, 6) AS pearson_r, round(mae, 6) AS mae, n_samples,
        round({_tail("asin(abs(r))").replace("{end}", _END)} / {_tail("0.0::DOUBLE").replace("{end}", "least(pi() / 2, 12 / sqrt(n_samples - 3))")}, 6) AS p_value, cohens_kappa
    FROM told JOIN (SELECT dim, cohens_kappa FROM kappa) k USING (dim)""")

# --- sampling -----------------------------------------------------------------
CHECKS["proportional_sample"] = with_(["lengths", "bucketed"], f""", counts AS (
    SELECT count(*) AS total, count(*) FILTER (bucket = 'short') AS s, count(*) FILTER (bucket = 'medium') AS m, count(*) FILTER (bucket = 'long') AS l FROM bucketed),
    q AS (SELECT least(s, floor(40 * s / total)) AS qs, least(m, floor(40 * m / total)) AS qm, l FROM counts)
    SELECT thread_id, num_turns, bucket FROM (
        SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY {draw('42', 'thread_id')}, thread_id) AS n FROM bucketed), q
    WHERE n <= CASE bucket WHEN 'short' THEN qs WHEN 'medium' THEN qm ELSE least(l, 40 - qs - qm) END""".lstrip())
CHECKS["cluster_sample"] = with_(["messages", "clustered"], "SELECT id, cluster_id::BIGINT AS cluster_id, place FROM clustered WHERE place <= 20")
CHECKS["stratified_sample"] = with_(CHOSEN, "SELECT id, intent, difficulty, is_adversarial, phase::BIGINT AS phase FROM chosen")
CHECKS["golden_rows"] = with_(CHOSEN, f"""SELECT printf('golden_%03d', row_number() OVER (ORDER BY {draw('42:shuffle', 'id')}, id)) AS id, id AS thread_id,
    intent AS gold_intent, 'auto_handle' AS gold_escalation, '' AS gold_escalation_reason, difficulty, is_adversarial,
    agent_response AS agent_actual_response, '' AS labeler_notes, {TEXT.format('text')} FROM chosen""")
CHECKS["sample_distribution"] = with_(CHOSEN, "SELECT difficulty, intent, count(*) AS n FROM chosen GROUP BY GROUPING SETS ((difficulty), (intent))")
CHECKS["cv_folds"] = with_(["gold"], f"""SELECT id, gold_intent, (row_number() OVER (PARTITION BY gold_intent ORDER BY {draw('42', 'id')}, id) - 1) % 5 AS fold FROM gold""")

# --- retrieval ----------------------------------------------------------------
CHECKS["l2_normalize"] = with_(["units"], "SELECT vec_id, unnest(range(len(u))) AS place, round(unnest(u), 6) AS value FROM units")
CHECKS["dense_topk"] = with_(["units", "nearest_all"], "SELECT query_id, corpus_id, score, rank FROM nearest")
CHECKS["dense_topk_exclude_self"] = with_(["units", "nearest_others"], "SELECT query_id, corpus_id, score, rank FROM nearest")
CHECKS["tfidf_weights"] = with_(["source_documents", "tokens", "terms", "vocabulary", "weights"], "SELECT id AS doc_id, term, round(weight, 6) AS weight FROM weights")
CHECKS["tfidf_top1"] = with_(["messages", "source_messages", "tokens", "terms", "vocabulary", "weights", "q_tokens", "q_terms", "q_weights"], f""", scored AS (
    SELECT b.item_id, m.id, m.agent_response, coalesce(s.score, 0) AS score FROM benchmark b CROSS JOIN messages m LEFT JOIN (
        SELECT item_id, w.id, round(sum(w.weight * v.weight), 9) AS score FROM q_weights v JOIN weights w USING (term) GROUP BY ALL) s
        ON s.item_id = b.item_id AND s.id = m.id)
    SELECT item_id AS query_id, id AS corpus_id, score,
        CASE WHEN score > 0 AND agent_response <> '' THEN agent_response ELSE {q(EMPTY_REPLY)} END AS reply
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, id) AS n FROM scored) WHERE n = 1""".lstrip())
CHECKS["silhouette_fixed_labels"] = with_(["compared", "distances"], """SELECT id, cluster::BIGINT AS cluster, round((b - a) / greatest(a, b), 6) AS silhouette FROM (
    SELECT id, cluster, sum(total) FILTER (other = cluster) / (sum(n) FILTER (other = cluster) - 1) AS a, min(total / n) FILTER (other <> cluster) AS b
    FROM distances GROUP BY id, cluster)""")
CHECKS["kmeans_facts"] = "SELECT count(*) AS vectors, 10::BIGINT AS clusters, 0::BIGINT AS misplaced, true AS as_tight_as_labels FROM embeddings"
CHECKS["optimal_k_facts"] = f"""SELECT {len(CLUSTER_COUNTS)}::BIGINT AS candidates, 1::BIGINT AS best_rows, 0::BIGINT AS higher, 0::BIGINT AS equal_and_smaller,
    0::BIGINT AS out_of_range"""
CHECKS["grounding_context"] = with_(NEAR, f"SELECT id AS query_id, {TEXT.format('shown')}, sources FROM grounding")

CHECKS["message_embedding"] = with_(["messages"], f"""SELECT id, 256::BIGINT AS dims,
    CASE WHEN regexp_matches(text, '{tx.WORD}{{2}}') THEN 1.0 ELSE 0.0 END::DOUBLE AS squares FROM messages""")

# --- models -------------------------------------------------------------------
LABELLED = ["messages", "gold", "labelled", "majority"]
CHECKS["trivial_baseline"] = with_(LABELLED, f"""SELECT id, (SELECT label FROM majority) AS intent, 1.0::DOUBLE AS intent_confidence, {q(TEMPLATE_REPLY)} AS reply,
    'auto_handle' AS decision, {q(TRIVIAL_REASON)} AS reason, 1.0::DOUBLE AS confidence, 'trivial' AS trigger FROM labelled""")
CHECKS["majority_intent"] = with_(["messages", "taxonomy", "sizes"], """SELECT coalesce(intent_label, 'cluster_' || s.cluster_id) AS majority, s.cluster_id::BIGINT AS cluster_id, cluster_size AS n
    FROM (SELECT * FROM sizes ORDER BY cluster_size DESC, cluster_id LIMIT 1) s LEFT JOIN taxonomy t ON t.cluster_id = s.cluster_id""")
CHECKS["logreg_facts"] = with_(LABELLED, """SELECT count(*) AS rows, count(DISTINCT gold_intent) AS classes, true AS flat, true AS optimal, 0::BIGINT AS unknown_answers,
    0::BIGINT AS impossible_confidences, true AS beats_chance FROM labelled""")
CHECKS["cv_facts"] = with_(LABELLED, f"""SELECT fold, count(*) AS rows, true AS is_share FROM (
    SELECT (row_number() OVER (PARTITION BY gold_intent ORDER BY {draw('42', 'id')}, id) - 1) % 5 AS fold FROM labelled) GROUP BY fold""")
SIMPLE = [*LABELLED, "source_labelled", "tokens", "terms", "vocabulary", "weights", "closest", "keyworded"]
CHECKS["simple_baseline_facts"] = with_(SIMPLE, f"""SELECT id, true AS known_intent, reply, decision, {KEYWORD_REASON} AS reason,
    CASE WHEN hit IS NULL THEN 0.6::DOUBLE ELSE 0.8::DOUBLE END AS confidence, 'keyword' AS trigger FROM keyworded JOIN closest USING (id)""")
CHECKS["baseline_batch_facts"] = with_(SIMPLE, f"""SELECT 'trivial' AS system, id, gold_intent, (SELECT label FROM majority) AS intent, {q(TEMPLATE_REPLY)} AS predicted_reply,
    'auto_handle' AS predicted_escalation FROM labelled
    UNION ALL SELECT 'simple', id, gold_intent, 'a gold intent', reply, decision FROM keyworded JOIN closest USING (id)""")
CHECKS["error_rows"] = with_(LABELLED, f"""SELECT id, CASE WHEN id % 10 = 7 THEN 'error' ELSE (SELECT label FROM majority) END AS intent,
    CASE WHEN id % 10 = 7 THEN '' ELSE {q(TEMPLATE_REPLY)} END AS reply, CASE WHEN id % 10 = 7 THEN 'escalate' ELSE 'auto_handle' END AS decision,
    CASE WHEN id % 10 = 7 THEN 'Error: broken ' || id ELSE {q(TRIVIAL_REASON)} END AS reason,
    CASE WHEN id % 10 = 7 THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence, CASE WHEN id % 10 = 7 THEN 'error' ELSE 'trivial' END AS trigger FROM labelled""")

# --- prompts, model calls, answers ----------------------------------------------
CLASSIFY = """'Choose the intent of the customer message below.' || chr(10) || chr(10) || 'Intents:' || chr(10) || (SELECT intents_text FROM rendered)
    || chr(10) || chr(10) || 'Customer message: "' || text || '"' || chr(10) || chr(10) || 'JSON keys: "intent" (one of: ' || (SELECT labels_text FROM rendered)
    || '), "confidence" (0.0 to 1.0), "reasoning" (one sentence)'"""
CHECKS["classify_prompts"] = with_(["messages", "taxonomy", "rendered"], f"SELECT id, {TEXT.format('p')} FROM (SELECT id, {CLASSIFY} AS p FROM messages)")
CHECKS["reply_prompts"] = with_([*NEAR, "taxonomy", "with_intent"], f"""SELECT id, {TEXT.format('p')} FROM (SELECT id,
    'Draft a reply to this customer.' || chr(10) || chr(10) || 'Intent: ' || intent || chr(10) || 'Customer message: "' || text || '"' || chr(10) || chr(10)
    || 'How similar cases were answered before:' || chr(10) || chr(10) || shown || chr(10) || chr(10)
    || 'JSON keys: "reply", "strategy" (short description of the approach)' AS p FROM with_intent JOIN grounding USING (id))""")
CHECKS["escalation_prompts"] = with_(INTENTS, f"""SELECT id, {TEXT.format('p')} FROM (SELECT id, 'Customer message: "' || text || '"' || chr(10) || 'Intent: ' || intent
    || chr(10) || 'Drafted reply: "' || agent_response || '"' || chr(10) || chr(10) || 'May this be answered automatically?' || chr(10)
    || 'JSON keys: "decision" ("auto_handle" or "escalate"), "reason", "confidence" (0.0 to 1.0)' AS p FROM with_intent)""")
RUBRIC = "\n".join(f"{i}. {d}: {prompts.RUBRIC_QUESTIONS[d]}" for i, d in enumerate(RUBRIC_DIMENSIONS, 1))
RUBRIC_KEYS = ", ".join(f'"{d}" (score 1-5, reasoning)' for d in RUBRIC_DIMENSIONS)
CHECKS["judge_prompts"] = with_(INTENTS, f"""SELECT id, {TEXT.format('p')} FROM (SELECT id, 'Grade this drafted reply.' || chr(10) || chr(10) || 'Customer message: "' || text || '"'
    || chr(10) || 'Intent: ' || intent || chr(10) || 'Drafted reply: "Draft ' || id || '"'
    || CASE WHEN agent_response <> '' THEN chr(10) || 'For comparison, the answer that was really given: "' || agent_response || '"' ELSE '' END
    || chr(10) || chr(10) || {q('Dimensions:' + chr(10) + RUBRIC)} || chr(10) || chr(10) || {q('JSON keys: ' + RUBRIC_KEYS + ', "overall_score", "overall_assessment"')} AS p
    FROM with_intent)""")
CHECKS["cluster_label_prompts"] = with_(["messages", "clustered", "sizes"], f"""SELECT cluster_id::BIGINT AS cluster_id, {TEXT.format('p')} FROM (
    SELECT cluster_id, 'Name the intent shared by these messages of cluster ' || cluster_id || ' (' || any_value(cluster_size) || ' messages in all):' || chr(10)
    || string_agg('  - "' || text || '"', chr(10) ORDER BY place) || chr(10) || chr(10) || 'Labels of another taxonomy, for style only: card_arrival, lost_card'
    || chr(10) || chr(10) || 'JSON keys: "intent_label" (snake_case), "description", "keywords", "typically_needs_escalation", "example_messages"' AS p
    FROM clustered JOIN sizes USING (cluster_id) WHERE place <= 15 GROUP BY cluster_id)""")
CHECKS["response_parse"] = with_(["scores"], """SELECT id, id % 7 < 3 AS readable, CASE WHEN id % 7 < 3 THEN dim END AS intent,
    CASE WHEN id % 7 < 3 THEN (k % 8) / 8.0::DOUBLE END AS confidence, CASE WHEN id % 7 < 3 THEN 'k' || k END AS reasoning FROM scores""")
CHECKS["intent_answers"] = with_(["scores"], f"""SELECT id, CASE WHEN NOT ok THEN {q(FAILED_INTENT)} WHEN dim IN ('view', 'click', 'purchase') THEN dim
    WHEN dim = 'signup' THEN 'sign' ELSE 'view' END AS intent, CASE WHEN ok THEN (k % 8) / 8.0::DOUBLE ELSE 0.0 END AS confidence
    FROM (SELECT *, id % 7 < 3 AND id % 13 <> 0 AS ok FROM scores)""")
CHECKS["judge_answers"] = with_(["scores"], """SELECT id,
    CASE WHEN id % 6 < 4 THEN (k % 5 + 1)::DOUBLE WHEN id % 6 = 5 THEN 0.0 END AS relevance,
    CASE WHEN id % 6 < 2 THEN 4.0 WHEN id % 6 = 5 THEN 0.0 END::DOUBLE AS tone,
    CASE id % 6 WHEN 0 THEN k % 5 + 0.5 WHEN 1 THEN round((k % 5 + 15) / 5, 2) WHEN 2 THEN round((k % 5 + 10) / 4, 2)
        WHEN 3 THEN round((k % 5 + 13) / 5, 2) WHEN 4 THEN 3.0 ELSE 0.0 END::DOUBLE AS overall_score FROM scores""")
CHECKS["overall_repair"] = with_(["scores"], """SELECT id, round(coalesce(overall_score, round_even((""" + " + ".join(
    f"CASE WHEN id % {n + 3} <> 0 THEN (k + {n}) % 5 + 1 ELSE 3 END" for n in range(5)) + """) / 5.0, 2)), 2)::DOUBLE AS overall_score FROM scores""")
STUB = f"""'{{"intent": "' || [{listing(fx.LABELS)}][id % {len(fx.LABELS)} + 1] || '", "confidence": 0.75, "reasoning": "stub"}}'"""
CHECKS["model_calls"] = with_(["messages", "taxonomy", "rendered"], f"""SELECT id, response, CASE WHEN response IS NULL THEN 0 ELSE length(p) END AS in_tokens,
    coalesce(length(response), 0) AS out_tokens, (CASE WHEN id % 10 IN (3, 7) THEN 3 ELSE 1 END)::BIGINT AS attempts,
    CASE WHEN id % 10 = 7 THEN 'no answer' END AS error FROM (SELECT id, {CLASSIFY} AS p, CASE WHEN id % 10 <> 7 THEN {STUB} END AS response FROM messages)""")
CHECKS["usage_totals"] = """SELECT count(*) AS total_calls, sum(length(props))::BIGINT AS total_input_tokens, sum(event_id % 97)::BIGINT AS total_output_tokens
    FROM events WHERE event_id % 10 <> 7"""
CHECKS["triage_rows"] = with_([*NEAR, "taxonomy"], f""", classified AS (
    SELECT id, text, CASE WHEN id % 10 = 7 THEN {q(FAILED_INTENT)} ELSE [{listing(fx.LABELS)}][id % {len(fx.LABELS)} + 1] END AS intent,
        {first_keyword_sql('lower(text)', rules.ESCALATION_RULES)} AS hit FROM vector_messages),
    marked AS (SELECT *, intent IN (SELECT intent_label FROM taxonomy WHERE flag) AS flagged FROM classified)
    SELECT id, intent, similar_ids, CASE WHEN id % 10 = 7 THEN {q(FAILED_REPLY)} ELSE 'Reply ' || id END AS reply, sources,
        CASE WHEN hit IS NOT NULL OR flagged OR id % 10 = 7 OR id % 2 = 1 THEN 'escalate' ELSE 'auto_handle' END AS decision,
        CASE WHEN hit IS NOT NULL THEN 'Triggered by ' || split_part(hit, '|', 1) || ' keyword: ''' || split_part(hit, '|', 2) || ''''
            WHEN flagged THEN {FLAG_REASON} WHEN id % 10 = 7 THEN {q(rules.FALLBACK_REASON)} ELSE 'stub' END AS reason,
        CASE WHEN hit IS NOT NULL THEN 0.95 WHEN flagged THEN 0.7 WHEN id % 10 = 7 THEN 0.3 ELSE 0.5 END::DOUBLE AS confidence,
        CASE WHEN hit IS NOT NULL THEN 'rule' WHEN flagged THEN 'taxonomy' WHEN id % 10 = 7 THEN 'fallback' ELSE 'llm' END AS trigger
    FROM marked JOIN grounding USING (id)""".lstrip())
CHECKS["judge_batch"] = with_(["messages", "gold", "labelled"], f"""SELECT id, {difficulty_sql('text', 'num_turns')} AS difficulty,
    CASE WHEN id % 10 IN (3, 7) THEN 0 ELSE id % 5 + 1 END::DOUBLE AS relevance, CASE WHEN id % 10 IN (3, 7) THEN 0 ELSE 4 END::DOUBLE AS tone,
    CASE WHEN id % 10 IN (3, 7) THEN 0 ELSE round((id % 5 + 14) / 5, 2) END::DOUBLE AS overall_score FROM labelled""")

# --- sources and sinks ----------------------------------------------------------
CHECKS["csv_roundtrip"] = with_(["posts"], "SELECT * FROM posts")
CHECKS["jsonl_roundtrip"] = with_(["posts"], "SELECT * FROM posts")
CHECKS["json_array_scan"] = with_(["messages"], "SELECT id, text, agent_response, cluster_id::BIGINT AS cluster_id FROM messages")
CHECKS["taxonomy_explode"] = with_(TOPICS, "SELECT cluster_id::BIGINT AS cluster_id, intent_label, cluster_size FROM topic_of JOIN sizes USING (cluster_id)")
CHECKS["taxonomy_document"] = CHECKS["taxonomy_explode"]
CHECKS["vector_roundtrip"] = "SELECT vec_id AS id, len(embedding) AS dims, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings"
CHECKS["report_document"] = with_(ALIGNED, """SELECT count(*) AS systems, round(max(a), 6) AS best_accuracy
    FROM (SELECT avg((gold_intent = pred_intent)::INT) AS a FROM aligned GROUP BY system)""")
CHECKS["materialize_once"] = with_(["lengths"], "SELECT run, run = 'again' AS skipped, (SELECT count(*) FROM lengths) AS n FROM (VALUES ('first'), ('again'), ('forced')) v(run)")

# --- whole steps ----------------------------------------------------------------
CHECKS["stats_document"] = with_([*BRAND_THREADS, "quota"], f"""SELECT {q(fx.BRAND)} AS brand, (SELECT count(*) FROM posts) AS raw_posts_total, (SELECT count(*) FROM ids) AS brand_posts_total,
    count(*) AS threads_total, (SELECT sampled::BIGINT FROM quota) AS threads_sampled, count(*) FILTER (num_turns <= 3) AS short_lte_3,
    count(*) FILTER (num_turns BETWEEN 4 AND 6) AS medium_4_6, count(*) FILTER (num_turns > 6) AS long_gt_6,
    round_even(avg(num_turns), 2) AS avg_thread_length FROM complete""", True)
VIEWS["thread_intent"] = f"""with_intent AS (
    SELECT thread_id AS id, customer_first_message AS text, agent_first_response AS agent_response, num_turns, coalesce(t.intent_label, 'unknown') AS intent
    FROM complete LEFT JOIN taxonomy t ON t.cluster_id = (thread_id // {fx.CONV_STEP}) % 10 WHERE length(customer_first_message) > 10)"""
CHECKS["golden_set"] = with_([*THREADS, "complete", "taxonomy", "thread_intent", *CHOSEN[3:]], f"""SELECT
    printf('golden_%03d', row_number() OVER (ORDER BY {draw('42:shuffle', 'id')}, id)) AS id, id AS thread_id, intent AS gold_intent, difficulty, is_adversarial,
    text AS customer_message, agent_response AS agent_actual_response, (SELECT string_agg(concat_ws(':', place::VARCHAR, role, m.text), chr(10) ORDER BY place)
        FROM thread_messages m WHERE m.thread_id = chosen.id AND place <= 6) AS context FROM chosen""", True)
CHECKS["cluster_labels"] = with_(["messages", "sizes"], """SELECT cluster_id::BIGINT AS cluster_id,
    CASE WHEN cluster_id % 10 = 7 THEN 'unknown' ELSE 'named_' || cluster_id END AS intent_label,
    CASE WHEN cluster_id % 10 = 7 THEN 'Cluster ' || cluster_id || ' (' || cluster_size || ' messages)' ELSE 'd' || cluster_id END AS description,
    CASE WHEN cluster_id % 10 = 7 THEN '' ELSE 'a,b' END AS keywords, cluster_id % 10 <> 7 AND cluster_id % 2 = 1 AS typically_needs_escalation, cluster_size FROM sizes""")
DIM_ROWS = " UNION ALL ".join(
    f"SELECT {q(d)} AS dim, ((k + {n}) % 6)::DOUBLE AS score FROM scores WHERE id % 7 <> {n}" for n, d in enumerate(RUBRIC_DIMENSIONS))
CHECKS["evaluation_document"] = with_([*ALIGNED, "label_rows", "classes", "f1s", "esc", "scores"], f""", dims AS ({DIM_ROWS}),
    dim_stats AS (SELECT dim, avg(score) AS mean, stddev_pop(score) AS std, min(score) AS min, max(score) AS max, median(score) AS median FROM dims GROUP BY dim),
    levels AS (SELECT difficulty, round_even(avg(overall_score), 2) AS mean, count(*)::DOUBLE AS n
        FROM (SELECT difficulty, overall_score FROM scores WHERE difficulty <> 'unknown' UNION ALL SELECT 'overall', overall_score FROM scores)
        WHERE overall_score <> 0 GROUP BY difficulty)
    SELECT 'intent_metrics' AS section, system AS name, 'accuracy' AS metric, round_even(avg((gold_intent = pred_intent)::INT), 3) AS value FROM aligned GROUP BY system
    UNION ALL SELECT 'intent_metrics', system, 'macro_f1', round_even(avg(f1), 3) FROM f1s GROUP BY system
    UNION ALL SELECT 'escalation_metrics', system, 'accuracy', round_even(same / n, 3) FROM esc
    UNION ALL SELECT 'escalation_metrics', system, 'escalation_recall', round_even(coalesce(tp / nullif(tp + fn, 0), 0), 3) FROM esc
    UNION ALL SELECT 'escalation_metrics', system, 'escalation_precision', round_even(coalesce(tp / nullif(tp + fp, 0), 0), 3) FROM esc
    UNION ALL SELECT 'judge_summary', dim, unnest(['mean', 'std', 'min', 'max', 'median']),
        unnest([round_even(mean, 2), round_even(std, 2), min, max, median]) FROM dim_stats
    UNION ALL SELECT 'overall_score', difficulty, unnest(['mean', 'n']), unnest([mean, n]) FROM levels
    UNION ALL SELECT 'per_class', system || '/' || label, 'f1', round_even(f1, 3) FROM f1s
    UNION ALL SELECT 'golden_set', 'all', 'size', count(DISTINCT id)::DOUBLE FROM aligned""".lstrip())
