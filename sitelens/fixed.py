"""Values that must equal the reference's for the same results."""

# --- Fixed values -------------------------------------------------------------
# text and index rules
LINE_SEP = "\n"                 # lines end at LF; CR stays in the line
TERM_SEP = " "                  # terms are split on the space byte only
MARKUP_FIRST_CHAR = "<"         # a markup line starts with '<' and has one more character
QUERY_SEPARATORS = " \r\n"      # a command's words are split on space, CR and LF
WORD_ENDS = " \n"               # the word counter ends a word at a space or LF

# links and requests
ANCHOR = "<a href="             # a link is the first quoted string after this literal
QUOTE = '"'
PARENT_PREFIX = "../"           # stripped once per hop (queue, fetch, server)
REQUEST_VERB = "Get"            # a request's first word, case-sensitive

# response statuses
STATUS_OK = 200
STATUS_FORBIDDEN = 403
STATUS_MISSING = 404

# commands and replies
STATS_COMMAND = "STATS\r\n"
SHUTDOWN_COMMAND = "SHUTDOWN\r\n"
SEARCH_VERB = "SEARCH"
UNKNOWN_REPLY = "Sorry , I don't serve this command."
IN_PROGRESS_REPLY = "Crawling still in progress.Sorry."
NO_RESULTS = "No results found"
SERVER_STATS_FORMAT = "Server up for %s , %d pages have been served ,%d bytes."
CRAWLER_STATS_FORMAT = "Server up for %s , %d downloads ,%d bytes."
SERVER_UNKNOWN_REPLY = "Sorry,I don't serve this command."
RESULT_HEADER_FORMAT = "%s : %d "   # page header of a search answer: path, hit lines
RESULT_ROW_SEPARATOR = ","          # answer rows are f,row,text
UPTIME_FORMAT = "%02d:%02d:%02d"
