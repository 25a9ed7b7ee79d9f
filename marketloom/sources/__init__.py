"""Reading extracts, storing layers and exporting results."""
