"""SQL surface for the model call: a lateral table function.

``register_predict_udtf(spark, call)`` registers ``ml_predict(prompt)`` so a
SQL user can write ``SELECT a.*, p.response FROM alerts a,
LATERAL ml_predict(a.prompt) p`` (inner: a NULL prompt yields no row). The
DataFrame path (``predict``) is preferred for throughput control; this one
shares its retry/timeout options.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from pylonflow.operators.infer import CallOptions, ModelCall, ModelSpec, _call_with_retry, _Pacer, pacing_key
from pylonflow.session import ship_package


def register_predict_udtf(spark: SparkSession, call: ModelCall, model: ModelSpec = ModelSpec(),
                          options: CallOptions = CallOptions(), name: str = "ml_predict") -> None:
    if options.total_calls_per_minute:
        raise ValueError("the SQL form has no fixed number of callers to split a total budget over; "
                         "use calls_per_minute (per worker) or predict(n_callers=...)")
    ship_package(spark)
    system_prompt = model.system_prompt
    params = {**model.params(), "client_timeout": options.client_timeout}
    min_gap = 60.0 / options.calls_per_minute if options.calls_per_minute else 0.0
    key = pacing_key(model, call, min_gap)

    @udtf(returnType=f"{model.output_col}: string", useArrow=True)
    class _ModelCall:
        def __init__(self):
            self.pacer = _Pacer(key, min_gap)   # same per-worker pacing as predict()

        def eval(self, prompt: str):
            if prompt is None:
                return
            yield (_call_with_retry(call, system_prompt, prompt, params, options,
                                    before_attempt=self.pacer.wait),)

    spark.udtf.register(name, _ModelCall)
