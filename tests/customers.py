"""A seeded customer table with a real signal in tenure and contract, and untidy cells."""

from __future__ import annotations

import numpy as np
import pandas as pd

from tabwright.fixed import CUSTOMER_COLUMNS


def customers(n: int = 3000, seed: int = 7) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    yes_no = lambda: rng.choice(["Yes", "No"], n)
    service = lambda: rng.choice(["Yes", "No", "No internet service"], n)
    tenure = rng.integers(0, 73, n)
    monthly = np.round(rng.uniform(18, 119, n), 2)
    contract = rng.choice(["Month-to-month", "One year", "Two year"], n, p=[0.55, 0.2, 0.25])
    odds = 1.0 - 0.06 * tenure + 1.4 * (contract == "Month-to-month")
    churn = rng.uniform(size=n) < 1 / (1 + np.exp(-odds))
    total = [f"{t * m:.2f}" if t else " " for t, m in zip(tenure, monthly)]
    df = pd.DataFrame(
        {
            "customerID": [f"{i:04d}-C" for i in range(n)],
            "gender": rng.choice(["Female", "Male"], n),
            "SeniorCitizen": rng.integers(0, 2, n),
            "Partner": yes_no(),
            "Dependents": yes_no(),
            "tenure": tenure,
            "PhoneService": yes_no(),
            "MultipleLines": service(),
            "InternetService": rng.choice(["DSL", "Fiber optic", "No"], n),
            "OnlineSecurity": service(),
            "OnlineBackup": service(),
            "DeviceProtection": service(),
            "TechSupport": service(),
            "StreamingTV": service(),
            "StreamingMovies": service(),
            "Contract": contract,
            "PaperlessBilling": yes_no(),
            "PaymentMethod": rng.choice(["Electronic check", "Mailed check", "Credit card"], n),
            "MonthlyCharges": monthly,
            "TotalCharges": total,
            "Churn": np.where(churn, "Yes", "No"),
        }
    )
    return df[CUSTOMER_COLUMNS]


def untidy(df: pd.DataFrame) -> pd.DataFrame:
    """Padded, missing, malformed and repeated cells on top of a tidy table."""
    out = df.astype(object).copy()
    out.loc[0:9, "gender"] = "  Female "
    out.loc[10:14, "Partner"] = None
    out.loc[15, "tenure"] = None
    out.loc[16, "MonthlyCharges"] = "not known"
    out.loc[17, "SeniorCitizen"] = None
    out.loc[18, "Churn"] = None
    again = out.loc[20:29].copy()
    again["gender"] = "Zed"
    return pd.concat([out, again], ignore_index=True)


def write_csv(df: pd.DataFrame, folder) -> str:
    path = folder / "customers.csv"
    df.to_csv(path, index=False)
    return str(path)
