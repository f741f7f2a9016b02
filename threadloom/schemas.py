"""Fixed schemas of the tables that enter and leave the system."""

from pyspark.sql import types as T

_S, _L, _I, _D, _B = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


POSTS = _struct(
    tweet_id=_S, author_id=_S, inbound=_B, created_at=_S, text=_S,
    response_tweet_id=_S, in_response_to_tweet_id=_S,
)

MESSAGE = _struct(role=_S, text=_S, raw_text=_S, tweet_id=_S, author_id=_S, created_at=_S)

THREADS = _struct(
    thread_id=_S, messages=T.ArrayType(MESSAGE), customer_first_message=_S,
    agent_first_response=_S, num_turns=_L, num_customer_msgs=_L, num_agent_msgs=_L,
)

CUSTOMER_MESSAGES = _struct(thread_id=_S, text=_S, agent_response=_S, cluster_id=_I)

INTENT = _struct(
    intent_label=_S, description=_S, keywords=T.ArrayType(_S), typically_needs_escalation=_B,
    cluster_id=_I, cluster_size=_L, example_messages=T.ArrayType(_S),
)

INTENT_MAP = T.MapType(_S, INTENT)

GOLDEN = _struct(
    id=_S, customer_message=_S, thread_context=T.ArrayType(MESSAGE), agent_actual_response=_S,
    gold_intent=_S, gold_escalation=_S, gold_escalation_reason=_S, gold_reply_quality_notes=_S,
    difficulty=_S, is_adversarial=_B, thread_id=_S, labeler_notes=_S,
)

INTENT_ANSWER = _struct(intent=_S, confidence=_D, reasoning=_S)
REPLY_ANSWER = _struct(reply=_S, grounding_sources=T.ArrayType(_S), strategy=_S)
ESCALATION_ANSWER = _struct(decision=_S, reason=_S, confidence=_D, trigger=_S)
SIMILAR_THREAD = _struct(thread_id=_S, customer_message=_S, agent_response=_S, similarity_score=_D)

PREDICTION = _struct(
    id=_S, input_message=_S, intent=INTENT_ANSWER, similar_threads=T.ArrayType(SIMILAR_THREAD),
    reply=REPLY_ANSWER, escalation=ESCALATION_ANSWER,
)

RUBRIC_DIMENSIONS = ["relevance", "tone", "actionability", "grounding", "safety"]

RUBRIC_SCORE = _struct(score=_D, reasoning=_S)

JUDGE = T.StructType(
    [T.StructField(dim, RUBRIC_SCORE) for dim in RUBRIC_DIMENSIONS]
    + [T.StructField("overall_score", _D), T.StructField("overall_assessment", _S),
       T.StructField("id", _S), T.StructField("difficulty", _S)]
)
