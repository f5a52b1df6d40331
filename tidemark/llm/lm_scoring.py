"""Language-model scores by masked pseudo-likelihood.

A bidirectional window network predicts every token from its neighbours on both sides; a document's score is the sum
of the log-probabilities of its tokens.  Tokens are words, with boundaries before and after each document.

Plan.  The network (`window_network`) has `window` neighbours on each side and as many hashed word units as the corpus
asks for.  One pass adds up the texts' bytes, one counts units, `rounds` passes train on disjoint slices that make up the
whole corpus, one scores with the network.  None of them shuffles documents; what is shuffled are counts and copies of
the model, one for each core.

Cases.  Null and empty texts have no tokens and score 0, their mean is null.  Texts of any length are scored whole.  Ids
may be null and may repeat: one row comes out for each row.  An empty table gives an empty result.  Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .window_network import Encoder, fit_network, slices


def pseudo_likelihood(docs: DataFrame, window: int = 4, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """One row per document: id, n_tokens, log_likelihood, mean_log_likelihood."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_network(docs, window, text_col=text_col, **training))

    def each() -> Callable:
        network = shared.value
        encoder = Encoder(network.units, network.window)

        def score(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            ids, counts = encoder.encode(texts)
            sums = np.concatenate([[0.0], np.cumsum(network.log_probabilities(encoder.joined(ids, counts)), dtype=np.float64)])
            return counts, np.diff(sums[np.concatenate([[0], np.cumsum(counts)])])

        def work(batch: pa.RecordBatch) -> dict:
            counts, sums = map(np.concatenate, zip(*map(score, slices(batch["text"])), strict=True))
            means = pa.array(sums / np.maximum(counts, 1), mask=counts == 0)
            return {id_col: batch["id"], "n_tokens": counts, "log_likelihood": sums, "mean_log_likelihood": means}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(chosen, each, f"`{id_col}` {kind}, n_tokens long, log_likelihood double, mean_log_likelihood double", 256)
