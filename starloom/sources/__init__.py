"""Tables, event files and maps in and out."""
