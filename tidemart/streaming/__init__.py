"""The stream from topic to Bronze, Silver and Quarantine."""
