"""Which timetable each day ran, and whole pipelines."""
