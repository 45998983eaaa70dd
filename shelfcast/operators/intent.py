"""Intent routing of question text (X07, re-aimed).

The source embeds a question with a sentence model and classifies it into
inventory / predictive / irrelevant from 30 labelled examples, one request at
a time.  Here the same 30 examples train a ``pyspark.ml`` text pipeline
(tokenise, hashed term frequencies, IDF, multinomial logistic regression)
and the model scores a whole text column as a distributed ``transform``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: the labelled routing examples (label 0 inventory, 1 predictive, 2 irrelevant).
TRAINING_EXAMPLES = [
    ("What is the total stock?", 0),
    ("Show me the inventory summary", 0),
    ("How many products do we have in Store A?", 0),
    ("Which items are low on stock?", 0),
    ("Summarize the current inventory", 0),
    ("List all products in stock", 0),
    ("Check restocking needs at Store B", 0),
    ("What's the status of inventory for product X?", 0),
    ("Show me the total units sold per store", 0),
    ("Give me a breakdown of product-wise stock", 0),
    ("Predict future sales for the next month", 1),
    ("Forecast inventory needs for next week", 1),
    ("What will be the stock levels after Christmas?", 1),
    ("Give me a sales prediction for Store C", 1),
    ("Analyze trends and predict stock exhaustion", 1),
    ("Run a predictive model on inventory data", 1),
    ("Forecast total units received next quarter", 1),
    ("When should I reorder items based on trends?", 1),
    ("Apply the predictive model to the current dataset", 1),
    ("What are the predicted trends for product Z?", 1),
    ("What's the weather today?", 2),
    ("Tell me a joke.", 2),
    ("How do I bake a cake?", 2),
    ("What's the meaning of life?", 2),
    ("Recommend a movie.", 2),
    ("Who won the World Cup?", 2),
    ("What is the capital of France?", 2),
    ("Can you sing a song?", 2),
    ("Tell me about dinosaurs.", 2),
    ("How do I fix my computer?", 2),
]
LABELS = ["inventory", "predictive", "irrelevant"]


def train_router(spark: SparkSession, num_features: int = 1 << 12, examples: list[tuple[str, int]] | None = None) -> PipelineModel:
    train = spark.createDataFrame(examples or TRAINING_EXAMPLES, "text string, label int") \
                 .withColumn("label", F.col("label").cast("double"))
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern="\\W+", toLowercase=True),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="tfidf"),
        LogisticRegression(featuresCol="tfidf", labelCol="label", family="multinomial", maxIter=100,
                           regParam=0.01),
    ])
    return pipe.fit(train)


def route(model: PipelineModel, texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Score a text column: label name and its probability."""
    df = texts.withColumnRenamed(text_col, "text") if text_col != "text" else texts
    out = model.transform(df)
    names = F.array(*[F.lit(x) for x in LABELS])
    return (out.withColumn("intent", F.element_at(names, F.col("prediction").cast("int") + 1))
               .withColumn("confidence", F.array_max(vector_to_array(F.col("probability"))))
               .drop("tokens", "tf", "tfidf", "rawPrediction", "probability", "prediction"))


def cross_validated_accuracy(spark: SparkSession, folds: int = 5, examples: list[tuple[str, int]] | None = None) -> float:
    """Share of the examples that a router trained on the other folds routes right (folds hold each label evenly)."""
    seen: dict[int, int] = {}
    fold_of = []
    for _, label in examples or TRAINING_EXAMPLES:
        seen[label] = seen.get(label, -1) + 1
        fold_of.append(seen[label] % folds)
    right = 0
    for k in range(folds):
        rest = [e for e, f in zip(examples or TRAINING_EXAMPLES, fold_of, strict=True) if f != k]
        held = [e for e, f in zip(examples or TRAINING_EXAMPLES, fold_of, strict=True) if f == k]
        routed = route(train_router(spark, examples=rest), spark.createDataFrame(held, "text string, label int"))
        names = F.array(*[F.lit(x) for x in LABELS])
        right += routed.filter(F.col("intent") == F.element_at(names, F.col("label") + 1)).count()
    return right / len(fold_of)
