"""Fixed values of the customer table: names, categories and settings that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Columns of the raw customer table, in file order.
CUSTOMER_COLUMNS = [
    "customerID",
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "tenure",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "MonthlyCharges",
    "TotalCharges",
    "Churn",
]

# Text columns that get a default when missing.
CATEGORICAL_COLUMNS = [
    "gender",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
]

# Columns counted as subscribed services, and the values that count.
SERVICE_COLUMNS = [
    "PhoneService",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]
SERVICE_VALUES = ["Yes", "Fiber optic", "DSL"]

# Upper bounds and names of the tenure groups.
TENURE_BOUNDS = [12, 24, 48]
TENURE_LABELS = ["0-12", "13-24", "25-48", "49+"]

# Default category, positive answer, split share and seed, median error.
MISSING_CATEGORY = "Unknown"
POSITIVE_ANSWER = "Yes"
TRAIN_SHARE = 0.8
SEED = 42
MEDIAN_ERROR = 0.01

# Settings of the two default models.
LOGISTIC_SETTINGS = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.0}
FOREST_SETTINGS = {"numTrees": 100, "maxDepth": 8}

# Number of search trials per model.
TRIALS = 6

# Models, runs, artifacts and tags as the run log names them.
MODELS = ["LogisticRegression", "RandomForest"]
ARTIFACTS = {"LogisticRegression": "logistic-regression-model", "RandomForest": "random-forest-model"}
SEARCH_RUN, FINAL_RUN, SELECTION_RUN = "Search_{}", "Final_{}", "Best_Model_Selection"
SEARCH_TYPE, FINAL_TYPE = "hyperparameter_tuning", "final_model"


@dataclass(frozen=True)
class CustomerTable:
    """Which column plays which part; replace it to run the jobs on another table."""

    key: str = "customerID"
    target: str = "Churn"
    positive: str = POSITIVE_ANSWER
    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    flags: tuple[str, ...] = ("SeniorCitizen",)
    categorical: tuple[str, ...] = tuple(CATEGORICAL_COLUMNS)
    services: tuple[str, ...] = tuple(SERVICE_COLUMNS)
    # Columns of the raw file in their order; empty takes them from the header.
    columns: tuple[str, ...] = tuple(CUSTOMER_COLUMNS)

    @property
    def numeric(self) -> tuple[str, ...]:
        return (*self.flags, self.tenure, self.monthly, self.total)

    @property
    def model_categorical(self) -> tuple[str, ...]:
        return (*self.categorical, "tenure_group")

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return (*self.numeric, "service_count", "avg_monthly_spend")


CUSTOMERS = CustomerTable()
