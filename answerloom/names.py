"""Column names and fixed vocabulary of the QA data model."""

ID = "ID"
QUESTION = "input"
ANSWER = "output"
SUBSET = "subset"

# Language prefixes of the subset codes and their display names.
LANGUAGES = {
    "Eng": "English",
    "Aka": "Akan",
    "Lug": "Luganda",
    "Swa": "Swahili",
    "Amh": "Amharic",
}

# Subsets with little training data.
LOW_RESOURCE = ["Aka_Gha", "Amh_Eth", "Lug_Uga", "Swa_Ken"]

# Submission layout, in order.
SUBMISSION_COLUMNS = ["ID", "TargetRLF1", "TargetR1F1", "TargetLLM"]
