"""Types of the vote JSON, and constants of the evaluation domain."""

from pyspark.sql import types as T

#: One element of the JSON array in ``eval_tasks.result``.
VOTE = T.StructType(
    [
        T.StructField("winner_id", T.LongType()),
        T.StructField("eval_dim_id", T.LongType()),
        T.StructField("eval_dim_key", T.StringType()),
    ]
)
VOTES = T.ArrayType(VOTE)

#: Fixed values of the domain.
DIMENSIONS = ("model_style", "result_relevance", "result_usefulness")
STATUS_FINISHED = 12
STATUS_SUBMITTED = 5
SESSION_QUESTIONS = 18
SESSION_NORMAL_QUESTIONS = 15
FIRST_SET_ID = 10
FAST_ANSWER_MINUTES = 0.25
