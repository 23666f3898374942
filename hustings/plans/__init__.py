"""Jobs made of operators: resolution of people, transcripts, registers, phrases, versions, links."""
