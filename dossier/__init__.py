"""dossier: builds one trustworthy profile per real-world entity from many overlapping directory sources, on Spark."""
