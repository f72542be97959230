"""Parts of error messages, notices and filler in many languages, from which the automaton of residue.py is built.

A notice is put together from a few kinds of parts: what it is about (SUBJECTS), what went wrong
(FAILURES), what the reader shall do (REQUESTS), and what scripts, cookies and browsers are called
(TECHNIQUES). No whole notice is listed: the parts of a sentence are found one by one and weighed
together, so any combination is recognised. '*' at an end stands for any further letters.
"""

from __future__ import annotations

#: What went wrong. A sentence needs one of these, or a request, to be a notice.
FAILURES = {
    "en": "failed|failure|fails to load|fails to display|cannot be displayed|can't be displayed|cannot be shown|can't be shown|cannot be loaded|can't be loaded|could not be loaded|couldn't be loaded|could not be displayed|could not be shown|could not be opened|could not be found|could not be retrieved|could not be rendered|could not be read|couldn't load|could not load|couldn't be found|couldn't find|can't find|cannot find|unable to load|unable to display|unable to connect|unable to retrieve|unable to find|not found|not available|unavailable|not supported|unsupported|not allowed|not permitted|no longer available|no longer exists|does not exist|doesn't exist|has been removed|was removed|was deleted|has been deleted|has expired|expired|timed out|timeout|denied|forbidden|refused|rejected|blocked|is blocked|invalid|corrupt*|broken|missing|went wrong|error|errors|exception|unexpected|crashed|offline|disabled|is disabled|is required|are required|exceeded|overloaded|under maintenance|down for maintenance|unreachable|can't be reached|cannot be reached|out of date|terminated|aborted|cancelled|canceled|unauthorized|unauthorised|restricted|does not work|doesn't work|cannot process|can't process|can't help|cannot help|can't provide|cannot provide|unable to provide|unable to help|unable to process|can't see|cannot see|unable to see|can't access|cannot access|unable to access|can't assist|cannot assist|unable to assist|can't generate|cannot generate|unable to generate|can't comply|cannot comply|can't fulfill|cannot fulfill",
    "de": "konnte nicht geladen werden|konnten nicht geladen werden|konnte nicht gefunden werden|konnte nicht angezeigt werden|konnte nicht geöffnet werden|kann nicht angezeigt werden|kann nicht geladen werden|kann nicht gefunden werden|können nicht angezeigt werden|nicht geladen|nicht gefunden|nicht verfügbar|nicht erreichbar|nicht unterstützt|nicht mehr verfügbar|existiert nicht|fehlgeschlagen|abgelaufen|verweigert|abgelehnt|gesperrt|blockiert|deaktiviert|erforderlich|benötigt|ungültig*|überschritten|fehler|fehler aufgetreten|ist ein fehler aufgetreten|schiefgelaufen|schief gelaufen|gelöscht|wurde entfernt|überlastet|veraltet|unterbrochen|kann ich nicht|nicht möglich|wartungsarbeiten|unbekannter",
    "fr": "n'a pas pu être chargée|n'a pas pu être chargé|n'a pas pu être affichée|n'a pas pu être trouvée|ne peut pas être affiché|ne peut pas être affichée|ne peut être affichée|ne peut être affiché|impossible de charger|impossible d'afficher|impossible de trouver|impossible d'ouvrir|impossible de se connecter|impossible|introuvable|non trouvé|non trouvée|indisponible|non disponible|n'est pas disponible|n'est plus disponible|n'existe pas|n'existe plus|a échoué|échec|échoué|refusé|refusée|interdit|expiré|expirée|a expiré|bloqué|bloqués|bloquée|désactivé|désactivés|requis|nécessaire|nécessite|erreur|s'est produite|est survenue|est survenu|invalide|dépassé|dépassée|supprimé|supprimée|obsolète|n'est pas pris en charge|non autorisé|je ne peux pas|maintenance",
    "es": "no se pudo cargar|no se ha podido cargar|no se puede cargar|no se puede mostrar|no se pudo mostrar|no se pudo abrir|no se pudo encontrar|no se encuentra|no se encontró|no se pudo conectar|no encontrado|no encontrada|no disponible|no está disponible|ya no está disponible|no existe|ya no existe|ha fallado|falló|error|ha ocurrido|se ha producido|se produjo|denegado|denegada|prohibido|caducado|ha caducado|caducada|expirado|ha expirado|bloqueado|bloqueada|bloqueados|desactivado|deshabilitado|necesario|requiere|se requiere|no válido|no válida|superado|excedido|eliminado|eliminada|obsoleto|no es compatible|no compatible|agotado|algo salió mal|salió mal|no puedo|mantenimiento",
    "pt": "não foi possível carregar|não foi possível exibir|não foi possível encontrar|não foi possível abrir|não foi possível conectar|não foi possível|não pôde ser carregada|não pôde ser carregado|não pode ser exibida|não pode ser exibido|não encontrada|não encontrado|indisponível|não disponível|não está disponível|não existe|falhou|falha|erro|ocorreu um erro|ocorreu|negado|proibido|expirou|expirada|bloqueado|bloqueados|desativado|desabilitado|necessário|requer|obrigatório|inválido|inválida|excedido|removido|removida|desatualizado|não é compatível|não suportado|algo deu errado|deu errado|não posso|manutenção",
    "it": "non può essere caricata|non può essere caricato|non può essere visualizzata|non può essere visualizzato|impossibile caricare|impossibile visualizzare|impossibile trovare|impossibile aprire|impossibile connettersi|impossibile|non trovata|non trovato|non disponibile|non è disponibile|non esiste|non è stato possibile|fallita|fallito|errore|si è verificato|negato|vietato|scaduta|scaduto|bloccato|bloccati|disabilitato|disattivato|necessario|richiede|richiesto|non valido|non valida|superato|rimosso|rimossa|obsoleto|non supportato|non è supportato|qualcosa è andato storto|andato storto|non posso|manutenzione",
    "nl": "kan niet worden geladen|kon niet worden geladen|kan niet worden weergegeven|kon niet worden weergegeven|kon niet worden gevonden|kan niet worden gevonden|niet geladen|niet gevonden|niet beschikbaar|niet meer beschikbaar|bestaat niet|mislukt|fout|fout opgetreden|opgetreden|geweigerd|verboden|verlopen|geblokkeerd|uitgeschakeld|vereist|nodig|ongeldig*|overschreden|verwijderd|verouderd|niet ondersteund|misgegaan|er ging iets mis|ging iets mis|kan ik niet|onderhoud",
    "sv": "kunde inte laddas|kunde inte visas|kunde inte hittas|kan inte visas|kan inte laddas|hittades inte|inte tillgänglig|inte tillgängligt|finns inte|misslyckades|fel|ett fel|inträffade|har inträffat|nekad|nekades|förbjuden|har gått ut|blockerad|blockerat|inaktiverat|krävs|kräver|ogiltig*|gick fel|stöds inte",
    "pl": "nie można załadować|nie udało się załadować|nie można wyświetlić|nie udało się wyświetlić|nie można znaleźć|nie znaleziono|niedostępn*|nie istnieje|nie powiodło się|błąd|wystąpił błąd|wystąpił|odmowa dostępu|odmówiono|zabronione|wygasła|wygasł|zablokowan*|wyłączon*|wymagan*|wymaga|nieprawidłow*|przekroczono|usunięt*|nie jest obsługiwan*|coś poszło nie tak|poszło nie tak",
    "ru": "не удалось загрузить|не удалось отобразить|не удалось найти|не удалось открыть|не удалось|невозможно загрузить|невозможно отобразить|невозможно|не найден*|недоступн*|не существует|ошибка|произошла ошибка|произошла|сбой|отказано|запрещен*|запрещён*|истек*|истёк|истекла|заблокирован*|отключен*|отключён*|требуется|необходим*|недействител*|превышен*|удален*|удалён*|не поддерживается|что-то пошло не так|пошло не так",
    "tr": "yüklenemedi|görüntülenemiyor|görüntülenemedi|bulunamadı|kullanılamıyor|mevcut değil|başarısız|başarısız oldu|hata|hatası|hata oluştu|oluştu|reddedildi|engellendi|yasak|süresi doldu|devre dışı|gerekli|gerekiyor|geçersiz|aşıldı|kaldırıldı|desteklenmiyor|ters gitti",
    "zh": "加载失败|无法加载|無法載入|无法显示|無法顯示|无法打开|无法访问|未找到|找不到|不存在|不可用|出错|出错了|发生错误|發生錯誤|错误|錯誤|失败|失敗|拒绝访问|拒绝|拒絕|被拒绝|禁止|已过期|過期|已失效|被屏蔽|已禁用|需要启用|需要|无效|超时|已删除|不支持|超出",
    "ja": "読み込めません|読み込めませんでした|読み込みに失敗しました|表示できません|表示できませんでした|見つかりません|見つかりませんでした|開けません|存在しません|利用できません|使用できません|エラー|発生しました|失敗しました|拒否されました|禁止|期限切れ|切れました|ブロックされ*|無効になっています|無効です|必要です|タイムアウト|削除されました|サポートされていません|対応していません|お使いいただけません",
    "ko": "불러올 수 없습니다|불러오지 못했습니다|로드할 수 없습니다|표시할 수 없습니다|찾을 수 없습니다|열 수 없습니다|존재하지 않습니다|사용할 수 없습니다|오류|오류가 발생했습니다|발생했습니다|실패했습니다|실패|거부되었습니다|거부|금지|만료되었습니다|차단되었습니다|비활성화*|필요합니다|지원되지 않습니다|잘못되었습니다",
}
#: What the reader shall do.
REQUESTS = {
    "en": "please|please enable|enable|turn on|switch on|activate|allow|accept|agree|try again|try again later|try later|reload|refresh|retry|come back later|check back later|contact|contact support|contact the administrator|log in|login|sign in|sign up|log in again|register|subscribe|update|upgrade|download|install|click here|verify|confirm|wait|please wait|loading|go back|return to",
    "de": "bitte|aktivieren|bitte aktivieren|einschalten|erlauben|zulassen|akzeptieren|zustimmen|versuchen|erneut|später|noch einmal|neu laden|laden sie|aktualisieren|melden sie sich an|anmelden|einloggen|warten|wird geladen|kontaktieren|bestätigen|herunterladen|klicken sie",
    "fr": "veuillez|veuillez activer|activez|activer|autoriser|accepter|acceptez|réessayer|réessayez|plus tard|recharger|rechargez|actualiser|actualisez|connectez-vous|se connecter|vous connecter|patienter|chargement|contactez|contacter|mettez à jour|mettre à jour|confirmez|cliquez ici|s'il vous plaît",
    "es": "por favor|active|activa|activar|habilite|habilitar|permitir|permita|acepte|aceptar|inténtelo|inténtalo|de nuevo|más tarde|vuelva a intentarlo|vuelva a cargar|recargue|recargar|actualice|actualizar|inicie sesión|iniciar sesión|espere|cargando|contacte|póngase en contacto|confirme|haga clic",
    "pt": "por favor|ative|ativar|habilite|habilitar|permita|aceite|aceitar|tente|tente novamente|novamente|mais tarde|recarregue|recarregar|atualize|atualizar|faça login|entre na sua conta|aguarde|carregando|contate|entre em contato|confirme|clique aqui",
    "it": "si prega di|per favore|attivare|attiva|abilitare|abilita|consentire|accettare|accetta|riprova|riprovare|riprova più tardi|più tardi|di nuovo|ricarica|ricaricare|aggiorna|aggiornare|accedi|effettua l'accesso|attendere|attendi|caricamento|contattare|conferma|clicca qui",
    "nl": "alstublieft|schakel|in te schakelen|inschakelen|inschakelt|accepteer|accepteren|toestaan|probeer|probeer het|opnieuw|later|herlaad|vernieuw|bijwerken|werk uw|log in|inloggen|meld u aan|even geduld|wachten|laden|neem contact op|bevestig|klik hier",
    "sv": "vänligen|aktivera|slå på|godkänn|acceptera|tillåt|försök|försök igen|igen|senare|ladda om|uppdatera|logga in|vänta|laddar|kontakta|bekräfta|klicka här|var god",
    "pl": "proszę|włącz|włączyć|zaakceptuj|zezwól|spróbuj|spróbuj ponownie|ponownie|później|odśwież|zaktualizuj|zaloguj się|czekać|ładowanie|skontaktuj się|potwierdź|kliknij tutaj",
    "ru": "пожалуйста|включите|включить|разрешите|примите|попробуйте|повторите|повторите попытку|ещё раз|еще раз|снова|позже|обновите|перезагрузите|войдите|войти|подождите|загрузка|свяжитесь|подтвердите|нажмите здесь",
    "tr": "lütfen|etkinleştirin|açın|izin verin|kabul edin|tekrar|tekrar deneyin|yeniden|daha sonra|yenileyin|güncelleyin|giriş yapın|oturum açın|bekleyin|yükleniyor|doğrulayın|tıklayın",
    "zh": "请|請|请启用|启用|開啟|开启|允许|接受|同意|请重试|重试|稍后|稍後再試|再试|重新加载|刷新|登录|登入|请稍候|加载中|联系|更新|确认",
    "ja": "してください|ください|有効にして*|有効に|許可して*|同意|再試行|再読み込み|もう一度|後で|後ほど|しばらく|お試し*|ログイン|お待ち*|読み込み中|更新|確認",
    "ko": "하세요|해 주세요|해주세요|하십시오|주십시오|활성화|허용|동의|다시|다시 시도|나중에|잠시 후|새로 고침|로그인|기다려|로딩 중|로드 중|업데이트|확인",
}
#: Scripts, cookies, browsers, and checks of visitors.
TECHNIQUES = {
    "": "javascript|java script|js|ecmascript|script|scripts|noscript|cookie|cookies|browser|captcha|recaptcha|webgl|flash player|flash|adobe flash player|plugin|plug-in|plugins|ad blocker|adblocker|html5|svg|canvas|http|https|html|ssl|dns|api|json|xml|sql|url|timeout|404|403|500|502|503|504|robot|bot",
    "de": "skript|skripte|browser|browsers|cookies|plugin", "fr": "navigateur|scripts|témoins|extension", "es": "navegador|scripts|complemento", "pt": "navegador|scripts|extensão", "it": "browser|script|estensione", "nl": "browser|scripts|invoegtoepassing",
    "sv": "webbläsare|webbläsaren|skript|kakor", "pl": "przeglądark*|skrypt*|plików cookie|ciasteczk*", "ru": "браузер*|скрипт*|куки|файлы cookie|капч*", "tr": "tarayıcı*|çerez*|betik*", "zh": "浏览器|瀏覽器|脚本|腳本|验证码", "ja": "ブラウザ|ブラウザー|スクリプト|クッキー", "ko": "브라우저|스크립트|쿠키|자바스크립트",
}
#: What a notice is about; counts only beside a failure, request or technique.
SUBJECTS = {
    "en": "image|images|picture|pictures|photo|figure|graphic|media|video|thumbnail|preview|file|files|page|pages|site|website|web site|content|contents|document|caption|description|alt text|server|connection|network|request|response|session|link|address|resource|resources|data|database|service|system|access|account|user|login|password|permission|viewer|player|gateway|proxy|host|application|app|feature|token|quota|query|internet|security|certificate|upload|download|administrator|support|something|see|load|show|continue|use|temporarily|currently|at this time|right now|while|occurred|again|later|sorry|we're sorry|we are sorry|apologies|oops|you|your|our|we|i|it|requested|attempting|trying|fatal|bad|unknown|code|properly|correctly|human|proceed|maintenance|minutes|seconds|few|moment|time",
    "de": "bild|bilder|bildes|abbildung|datei|seite|webseite|website|inhalt|inhalte|dokument|beschreibung|server|verbindung|anfrage|sitzung|link|adresse|dienst|system|zugriff|konto|daten|datenbank|netzwerk|berechtigung|dieses|diese|dieser|dieses bild|diesen|ihr|ihre|ihrem|ihren|wir|es|leider|entschuldigung|derzeit|momentan|vorübergehend|angeforderte|angeforderten|beim laden|laden|anzuzeigen|anzeigen|anzeige|sehen|interner|unerwarteter|ist|sind|wurde|werden|konnte|kann|nicht|fortzufahren|augenblick|moment|minuten|aufgetreten",
    "fr": "image|images|figure|photo|fichier|page|site|contenu|document|description|légende|serveur|connexion|requête|session|lien|adresse|ressource|service|système|accès|compte|données|base de données|réseau|cette|ce|cet|votre|vous|nous|désolé|désolée|actuellement|temporairement|momentanément|demandée|demandé|lors du chargement|chargement|afficher|affichage|voir|interne|inattendue|n'a pas|pour continuer|instant|instants|minutes|ce contenu|une|dans",
    "es": "imagen|imágenes|figura|foto|archivo|página|sitio|contenido|documento|descripción|servidor|conexión|solicitud|sesión|enlace|dirección|recurso|servicio|sistema|acceso|cuenta|datos|base de datos|red|esta|este|su|usted|nosotros|lo sentimos|sentimos|actualmente|temporalmente|solicitada|solicitado|al cargar|cargar|mostrar|ver|interno|inesperado|continuar|momento|minutos|que busca|ya|se|no|ha|un",
    "pt": "imagem|imagens|figura|foto|arquivo|ficheiro|página|site|conteúdo|documento|descrição|legenda|servidor|conexão|solicitação|sessão|link|endereço|recurso|serviço|sistema|acesso|conta|dados|banco de dados|rede|esta|este|seu|sua|você|desculpe|lamentamos|no momento|temporariamente|solicitada|solicitado|ao carregar|carregar|exibir|ver|visualizar|interno|inesperado|continuar|momento|minutos|um|uma|não|foi|está",
    "it": "immagine|immagini|figura|foto|file|pagina|sito|contenuto|documento|descrizione|didascalia|server|connessione|richiesta|sessione|collegamento|indirizzo|risorsa|servizio|sistema|accesso|account|dati|rete|questa|questo|tuo|tua|ci dispiace|siamo spiacenti|spiacenti|momentaneamente|temporaneamente|richiesta|richiesto|durante il caricamento|caricare|visualizzare|vedere|interno|imprevisto|continuare|momento|minuti|un|una|è|stato",
    "nl": "afbeelding|afbeeldingen|figuur|foto|bestand|pagina|site|website|inhoud|document|beschrijving|server|verbinding|verzoek|sessie|link|adres|dienst|systeem|toegang|account|gegevens|netwerk|deze|dit|uw|je|wij|helaas|sorry|momenteel|tijdelijk|opgevraagde|gevraagde|bij het laden|laden|weergeven|bekijken|te bekijken|zien|interne|onverwachte|doorgaan|moment|minuten|er is een|is",
    "sv": "bilden|bild|filen|sidan|sida|innehållet|dokumentet|beskrivning|servern|anslutningen|sessionen|länken|åtkomst|kontot|din|ditt|denna|detta|den|tyvärr|just nu|tillfälligt|begärda|vid|laddning|visa|se|oväntat|fortsätta|för att",
    "pl": "obraz|obrazu|obrazek|plik|pliku|strona|strony|treść|treści|dokument|opis|serwer|serwera|połączenie|sesja|link|zasób|dostęp|dostępu|konto|dane|ta|ten|twoja|twoje|przepraszamy|obecnie|chwilowo|żądana|podczas|ładowania|wyświetlić|zobaczyć|wewnętrzny|nieoczekiwany|aby|kontynuować|chwilę",
    "ru": "изображение|изображения|картинка|картинку|файл|страница|страницу|страницы|сайт|содержимое|контент|документ|описание|сервер|сервера|соединение|подключение|запрос|сеанс|сессия|ссылка|ресурс|доступ|аккаунт|данные|эта|этот|ваш|ваша|вы|извините|к сожалению|временно|в данный момент|запрошенная|при загрузке|загрузки|просмотра|отобразить|внутренняя|неожиданная|продолжить|чтобы|для|на|в|минут",
    "tr": "görsel|görseli|resim|resmi|dosya|sayfa|sayfası|içerik|içeriği|belge|açıklama|sunucu|sunucusu|bağlantı|istek|oturum|oturumunuz|kaynak|erişim|hesap|veri|bu|sizin|üzgünüz|şu anda|geçici olarak|istenen|yüklenirken|görmek|görüntülemek|iç|beklenmeyen|devam etmek|için|bir|lütfen",
    "zh": "图片|圖片|图像|影像|文件|檔案|页面|頁面|网页|网站|内容|內容|文档|描述|说明|服务器|伺服器|连接|連線|请求|会话|链接|资源|访问|權限|权限|账户|数据|该|此|您的|您|我们|抱歉|很抱歉|对不起|暂时|目前|所请求的|查看|显示|内部|继续|的|以|了|已|在|时",
    "ja": "画像|この画像|写真|図|ファイル|ページ|このページ|サイト|コンテンツ|内容|文書|説明|サーバー|サーバ|接続|リクエスト|セッション|リンク|リソース|アクセス|アカウント|データ|権限|この|申し訳ありません|申し訳ございません|現在|一時的に|要求された|表示|内部|続行|の|を|が|は|に|するには|ため|が",
    "ko": "이미지|이미지를|사진|파일|파일을|페이지|페이지를|사이트|콘텐츠|콘텐츠를|내용|문서|설명|서버|연결|요청|세션|세션이|링크|리소스|접근|액세스|액세스가|계정|데이터|이|귀하의|죄송합니다|현재|일시적으로|요청한|보려면|표시|내부|계속하려면|를|을|가|에",
}
#: Filler that asks for a text, and names for a text that is still to be written: verb, object, place.
FILLER_VERBS = {
    "en": "insert|enter|add|write|put|provide|type|describe|replace|fill in|fill|supply|edit|to be added|to be written|to be supplied|to be completed|to be provided|goes here|go here|coming soon|not yet written|pending|tbd|tba|todo|fixme|placeholder|dummy|sample|lorem ipsum|untitled|unnamed|default|change me",
    "de": "einfügen|eingeben|einsetzen|ergänzen|ersetzen|beschreiben sie|hinzufügen|folgt|noch zu ergänzen|platzhalter|beispieltext|blindtext|mustertext|ausfüllen|eintragen", "fr": "insérer|insérez|saisir|saisissez|ajouter|ajoutez|entrez|entrer|écrire|remplacer|à compléter|à remplir|à venir|texte de remplacement|texte provisoire|exemple de texte",
    "es": "insertar|inserte|introducir|introduzca|añadir|añada|agregar|agregue|escriba|escribir|reemplazar|por completar|pendiente|texto de relleno|texto de ejemplo|marcador de posición", "pt": "inserir|insira|adicionar|adicione|digite|escreva|substituir|substitua|a preencher|pendente|texto de exemplo|texto provisório|preencher", "it": "inserire|inserisci|aggiungere|aggiungi|scrivere|scrivi|sostituire|da completare|da inserire|testo segnaposto|testo di esempio|segnaposto",
    "nl": "invoegen|voer|invoeren|toevoegen|voeg|schrijf|vervangen|vul in|invullen|aanvullen|nog aan te vullen|tijdelijke tekst|voorbeeldtekst|plaatshouder", "sv": "infoga|ange|lägg till|skriv|ersätt|fyll i|platshållare|exempeltext", "pl": "wstaw|wpisz|dodaj|napisz|uzupełnij|zastąp|do uzupełnienia|tekst zastępczy|przykładowy tekst", "ru": "вставьте|введите|добавьте|напишите|замените|заполните|здесь будет|будет добавлено|текст-заполнитель|пример текста|заполнитель",
    "tr": "ekleyin|girin|yazın|buraya|doldurun|yer tutucu|örnek metin", "zh": "请输入|输入|在此输入|添加|填写|替换|待补充|待填|占位符|示例文本|占位文本", "ja": "入力してください|入力|挿入|追加|記入|後で追加|プレースホルダー|サンプルテキスト|ダミーテキスト", "ko": "입력하세요|입력|삽입|추가하세요|추가 예정|작성|자리표시자|예시 텍스트|샘플 텍스트",
}
FILLER_OBJECTS = {
    "en": "caption|captions|description|text|title|alt text|label|name|image description|image caption|figure caption|content|summary|here|below|a|your|the|this|later|author|of this image|of the image|for this figure|short|brief|image|figure",
    "de": "beschreibung|bildbeschreibung|bildunterschrift|unterschrift|text|titel|legende|bezeichnung|hier|kurze|bitte|ihre|ihren|bildes|bild", "fr": "description|légende|texte|titre|ici|votre|une|la|l'image|de l'image|image|courte", "es": "descripción|leyenda|texto|título|pie de foto|pie de imagen|aquí|su|una|la|imagen|de la imagen", "pt": "descrição|legenda|texto|título|aqui|sua|uma|a|imagem|da imagem", "it": "descrizione|didascalia|testo|titolo|qui|la|una|immagine|dell'immagine",
    "nl": "beschrijving|bijschrift|onderschrift|tekst|titel|hier|uw|een|afbeelding|van de afbeelding", "sv": "beskrivning|bildtext|text|titel|här|din|en|bild", "pl": "opis|podpis|tekst|tytuł|tutaj|swój|obrazu|obraz", "ru": "описание|подпись|текст|заголовок|здесь|сюда|ваш|изображения|краткое", "tr": "açıklama|açıklamayı|altyazı|metin|başlık|burada|görsel", "zh": "描述|说明|图片说明|图片描述|标题|文字|文本|此处|在此|图片", "ja": "説明|キャプション|説明文|テキスト|タイトル|ここに|ここ|画像の", "ko": "설명|캡션|텍스트|제목|여기에|여기|이미지",
}


def parts(table: dict[str, str]) -> list[str]:
    return sorted({p for line in table.values() for p in line.split("|")})
