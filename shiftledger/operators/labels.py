"""Published column labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labels of the two report sheets (the last one ends in a space).
DETAIL_LABELS = {
    "day": "Data",
    "full_name": "Imię i Nazwisko",
    "login": "Login",
    "bibi": "BIBI",
    "department": "Departament",
    "job_function": "Funkcja",
    "hc_or_agency": "HC/AGENCY",
    "position": "Pozycja",
    "shift_id": "Zmiana",
    "start_hm": "StartPracy",
    "stop_hm": "Koniec Pracy",
    "duration_hm": "Czas Pracy",
    "action": "Przerwa",
}
SUMMARY_LABELS = {
    "login": "Login",
    "day": "Data",
    "full_name": "Imię i Nazwisko",
    "bibi": "BIBI",
    "department": "Departament",
    "job_function": "Funkcja",
    "hc_or_agency": "HC/AGENCY",
    "position": "Pozycja",
    "shift_id": "Zmiana",
    "start_hm": "StartPracy",
    "stop_hm": "Koniec Pracy",
    "worked_hm": "Czas Pracy",
    "break_hm": "Przerwa śniadaniowa",
    "comment": "Komentarz",
    "start_check": "Rozpoczęcie",
    "end_check": "Zakończenie",
    "hours_check": "Sprawdzenie czasu pracy",
    "break_check": "Sprawdzanie śniadaniowa",
    "verdict": "Podsumowanie ",
}


def labeled(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Columns in published order under their labels."""
    return df.select(*[F.col(name).alias(label) for name, label in labels.items()])
