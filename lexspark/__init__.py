"""lexspark: a lexical-selection and corpus-preparation engine on PySpark."""
