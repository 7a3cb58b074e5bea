"""Jobs that users run: each a function of a session and a command line."""
